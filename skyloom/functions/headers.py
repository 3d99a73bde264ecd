"""Header maps and JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.constants import BANDS

# --- fixed values: typed image columns and the header keys that fill them ---
HEADER_COLUMNS = {
    "obsjd": ("OBSJD", "double"), "infobits": ("INFOBITS", "int"), "pid": ("DBPID", "long"),
    "nid": ("DBNID", "int"), "expid": ("DBEXPID", "int"), "seeing": ("SEEING", "double"),
    "airmass": ("AIRMASS", "double"), "moonillf": ("MOONILLF", "double"), "moonesb": ("MOONESB", "double"),
    "maglimit": ("MAGLIM", "double"), "crpix1": ("CRPIX1", "double"), "crpix2": ("CRPIX2", "double"),
    "crval1": ("CRVAL1", "double"), "crval2": ("CRVAL2", "double"), "cd11": ("CD1_1", "double"),
    "cd12": ("CD1_2", "double"), "cd21": ("CD2_1", "double"), "cd22": ("CD2_2", "double"),
    "ipac_gid": ("PROGRMID", "int"), "exptime": ("EXPTIME", "double"),
}
KEY_COLUMNS = {"field": "FIELDID", "ccdid": "CCDID", "qid": "QID", "fid": "FILTERID"}
# --- fixed values: solved-header keys that must not overwrite an image's own
SOLVED_DROP = ("FLXSCALE", "MAGZEROP", "PHOTIRMS", "PHOTINST", "PHOTLINK", "COMMENT", "HISTORY")


def header_extract(images: DataFrame, header: str = "header") -> DataFrame:
    """Fill null typed columns from the header; the partition key is always taken from it.

    ``filtercode`` follows from the filter, ``imgtypecode`` and ``filefracday`` from ``FILENAME``. Reading raises for a
    header without a key of the partition, and for one without ``FILENAME`` if a column needs it.
    """
    found = lambda key: F.try_element_at(F.col(header), F.lit(key))
    get = lambda key, kind: found(key).try_cast(kind)

    def needed(key: str, kind: str) -> Column:
        error = F.raise_error(F.lit(f"the header has no usable {key}"))
        return F.coalesce(get(key, kind), error.cast(kind))

    def filled(name: str, value: Column) -> Column:
        return F.coalesce(F.col(name), value) if name in images.columns else value

    out = {}
    for name, (key, kind) in HEADER_COLUMNS.items():
        out[name] = filled(name, get(key, kind))
    for name, key in KEY_COLUMNS.items():
        out[name] = needed(key, "int")
    bands = F.create_map(*[F.lit(v) for pair in BANDS.items() for v in pair])
    file = needed("FILENAME", "string")
    out["filtercode"] = filled("filtercode", F.try_element_at(bands, out["fid"]))
    out["imgtypecode"] = filled("imgtypecode", F.substring(F.substring_index(file, ".", 1), -1, 1))
    out["filefracday"] = filled("filefracday", F.get(F.split(file, "_"), F.lit(1)).try_cast("long"))
    return images.withColumns(out)


def header_scalars(header: Column) -> Column:
    """Keep entries whose JSON value is a number, string or boolean.

    ``header`` maps keys to JSON text; containers and nulls are dropped.
    """
    return F.map_filter(header, lambda k, v: v.isNotNull() & ~F.ltrim(v).rlike(r"^([\[{]|null\s*$)"))


def header_merge(base: Column, solved: Column, drop: tuple[str, ...] = SOLVED_DROP) -> Column:
    """Overlay a solved header; its photometric and comment keys are ignored."""
    kept = F.map_filter(solved, lambda k, v: ~k.isin(*drop))
    own = F.map_filter(base, lambda k, v: ~F.map_contains_key(kept, k))
    return F.map_concat(own, kept)


def _json_ready(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_json_ready(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: _json_ready(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(col, lambda k, v: _json_ready(v, kind.valueType))
    if isinstance(kind, T.BinaryType):
        return F.decode(col, "UTF-8")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return col


def json_encode(col: Column, kind: T.StructType) -> Column:
    """JSON text with NaN as null, ISO times and text for bytes; null fields are kept."""
    return F.to_json(_json_ready(col, kind), {"ignoreNullFields": "false"})


def angle_changed(cur: Column, new: Column) -> Column:
    """True unless both are equal within 1e-8 + 1e-5*|new|; null counts as changed."""
    return F.coalesce(F.abs(cur - new) > F.abs(new) * 1e-5 + 1e-8, F.lit(True))
