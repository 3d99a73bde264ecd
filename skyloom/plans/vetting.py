"""Vetting of sources against catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as K
from skyloom.functions.photometry import abmag
from skyloom.operators.aggregates import distinct_names
from skyloom.operators.ranking import closest_three

from skyloom.operators.sky import cone_join
from skyloom.session import store

ARCSEC = 1.0 / 3600.0

# --- fixed values: reasons of the veto rules, in the order they are applied ---
REASON_STAR = "matched to GAIA dr8"
REASON_MASKED = "matched to dr8 masked source ID"
REASON_HITS = "matched to hits  ID "
REASON_QUASAR = "matched to MQ  ID "
REASON_PSF = "right on top of (< 1 arcsec) DR8 PSF "
REASON_REDSHIFT = "rejected for having z_dr8 < 0.0001"
MIN_REDSHIFT = 0.0001
NO_SPEC_Z = -99.0


NEIGHBOR_COLUMNS = (
    "objid", "ra", "dec", "type", "parallax", "fracmasked_g", "fracmasked_r", "fracmasked_z", "z_spec", "z_phot_median",
)


def neighbors(sources: DataFrame, north: DataFrame, south: DataFrame) -> DataFrame:
    """Catalog rows within 30 arcsec of a source: ``sid``, ``sep``, ``half`` (0 north, 1 south), stored once.

    Every rule and the redshift read this table, so each catalog half is read once.
    """
    both = north.withColumn("half", F.lit(0)).unionByName(south.withColumn("half", F.lit(1)))
    pairs = cone_join(both, sources.select(F.col("id").alias("sid"), "ra", "dec"), K.NEIGHBOR_RADIUS_DEG, b_prefix="s_")
    out = pairs.withColumn("sep", F.col("sep_deg") * 3600).withColumnRenamed("s_sid", "sid").drop("s_ra", "s_dec", "sep_deg")
    return store(out)


def _flat_rules(near: DataFrame) -> DataFrame:
    """Rules decided on the neighbour alone, as (sid, rule, reason)."""
    c = F.col
    masked = (c("fracmasked_g") > 0.2) | (c("fracmasked_r") > 0.2) | (c("fracmasked_z") > 0.2)
    rules = [
        (1, (c("parallax") > 0) & (c("sep") < 1.5), REASON_STAR),
        (2, masked & (c("sep") < 2), REASON_MASKED),
        (5, (c("type") == "PSF") & (c("sep") < 1), REASON_PSF),
    ]
    fired = F.array(*[
        F.when(F.coalesce(cond, F.lit(False)), F.struct((c("half") * 5 + n).alias("rule"), F.lit(text).alias("reason")))
        for n, cond, text in rules
    ])
    hits = near.select("sid", F.explode(F.filter(fired, lambda r: r.isNotNull())).alias("r"))
    return hits.select("sid", "r.*")


def _list_rules(near: DataFrame, lists: list[tuple[int, DataFrame, str]]) -> DataFrame:
    """A neighbour within 1.5 arcsec that lies within 1.5 arcsec of a listed object; smallest id in the reason."""
    listed = None
    for number, table, text in lists:
        part = table.select("id", "ra", "dec", F.lit(number).alias("number"), F.lit(text).alias("text"))
        listed = part if listed is None else listed.unionByName(part)
    close = near.filter(F.col("sep") < 1.5).select("sid", "half", "ra", "dec")
    hits = cone_join(close, listed, 1.5 * ARCSEC, b_prefix="l_")
    named = hits.groupBy("sid", (F.col("half") * 5 + F.col("l_number")).alias("rule"), "l_text").agg(F.min("l_id").alias("_id"))
    return named.select("sid", "rule", F.concat("l_text", F.col("_id").cast("string")).alias("reason"))


def veto_reasons(
    sources: DataFrame, north: DataFrame, south: DataFrame, hits: DataFrame, quasars: DataFrame,
    redshifts: DataFrame | None = None, near: DataFrame | None = None,
) -> DataFrame:
    """(id, rule, reason) of the last rule that rejects each source.

    Per catalog half, north first: star with parallax, masked neighbour, listed
    variable, listed quasar, point source on top. Then the redshift rule. All rules
    fire at once and the highest number wins, combined before the shuffle.
    """
    if near is None:
        near = neighbors(sources, north.select(*NEIGHBOR_COLUMNS), south.select(*NEIGHBOR_COLUMNS))
    fired = _flat_rules(near).unionByName(_list_rules(near, [(3, hits, REASON_HITS), (4, quasars, REASON_QUASAR)]))
    z = redshifts if redshifts is not None else _nearest_redshift(near)
    no_host = sources.select("id").join(z.select("id", "redshift"), "id", "left").filter(
        F.col("redshift").isNull() | (F.col("redshift") <= MIN_REDSHIFT)
    )
    fired = fired.unionByName(no_host.select(F.col("id").alias("sid"), F.lit(11).alias("rule"), F.lit(REASON_REDSHIFT).alias("reason")))
    return fired.groupBy("sid").agg(F.max("rule").alias("rule"), F.max_by("reason", "rule").alias("reason")).withColumnRenamed("sid", "id")


def veto_sources(
    sources: DataFrame, north: DataFrame, south: DataFrame, hits: DataFrame, quasars: DataFrame,
    scores: DataFrame | None = None, redshifts: DataFrame | None = None,
) -> DataFrame:
    """Sources with ``score`` and ``altdata``; rejected ones get -1 and the reason as JSON.

    ``scores(source_id, score)`` are the summed real/bogus scores (E1).
    """
    reasons = veto_reasons(sources, north, south, hits, quasars, redshifts)
    out = sources.join(reasons, "id", "left")
    score = F.col("score") if "score" in sources.columns else F.lit(None).cast("double")
    if scores is not None:
        out = out.join(scores.select(F.col("source_id").alias("id"), F.col("score").alias("_sum")), "id", "left")
        score = F.coalesce("_sum", score)
    alt = F.col("altdata") if "altdata" in sources.columns else F.lit(None).cast("string")
    rejected = F.to_json(F.struct(F.col("reason").alias("rejected")))
    keep = [c for c in sources.columns if c not in ("score", "altdata")]
    return out.select(
        *keep, F.when(F.col("rule").isNotNull(), F.lit(-1.0)).otherwise(score).alias("score"),
        F.when(F.col("rule").isNotNull(), rejected).otherwise(alt).alias("altdata"),
    )


def _nearest_redshift(near: DataFrame, *more: Column) -> DataFrame:
    """(id, redshift, ...) of each source's nearest neighbour; a southern one goes before a northern one."""
    z = F.when(F.col("z_spec") == NO_SPEC_Z, F.col("z_phot_median")).otherwise(F.col("z_spec"))
    # smallest first: southern half, then distance, then id
    order = F.struct(-F.col("half"), "sep", "objid")
    best = near.groupBy(F.col("sid").alias("id")).agg(F.min_by(F.struct(z.alias("redshift"), *more), order).alias("h"))
    return best.select("id", "h.*")


def host_redshift(sources: DataFrame, north: DataFrame, south: DataFrame) -> DataFrame:
    """(id, redshift, neighbor_info) from the nearest neighbour within 30 arcsec.

    The spectroscopic value, or the photometric median where there is none; a
    southern neighbour overrides a northern one. ``neighbor_info`` is the whole
    catalog row as JSON.
    """
    near = neighbors(sources, north, south)
    info = F.to_json(F.struct(*north.columns, "sep")).alias("neighbor_info")
    return _nearest_redshift(near, info)


# --- fixed values: catalog column to alert field stem --------------------------
PS1_FIELDS = {"objid": "objectidps", "ps_score": "sgscore", "sep": "distpsnr",
              "gmag": "psgmag", "rmag": "psrmag", "imag": "psimag", "zmag": "pszmag"}
LEGACY_FIELDS = {
    "sep": "lsdistnr", "objid": "lsobjectid", "type": "lstype", "ebv": "lsebv",
    "g": "lsg", "r": "lsr", "z": "lsz", "w1": "lsw1_", "w2": "lsw2_", "w3": "lsw3_", "w4": "lsw4_",
    "gaia_phot_g_mean_mag": "lsgaiag", "parallax": "lsgaiap",
    "z_phot_mean": "lszphotmean", "z_phot_median": "lszphotmed", "z_phot_std": "lszphotstd",
    "z_phot_l68": "lszphotl68", "z_phot_u68": "lszphotu68", "z_phot_l95": "lszphotl95", "z_phot_u95": "lszphotu95",
    "z_spec": "lszspec",
}
LEGACY_BANDS = ("g", "r", "z", "w1", "w2", "w3", "w4")
NO_SCORE = -999.0
HALF_DEC = 32.0


def closest_ps1(det: DataFrame, ps1: DataFrame, scores: DataFrame) -> DataFrame:
    """The three nearest point-source neighbours per detection within 30 arcsec, with their star score."""
    pairs = cone_join(ps1, det.select("id", "ra", "dec"), K.NEIGHBOR_RADIUS_DEG, b_prefix="d_")
    pairs = pairs.withColumn("sep", F.col("sep_deg") * 3600)
    pairs = pairs.join(scores.select("objid", "ps_score"), ["objid"], "left")
    pairs = pairs.withColumn("ps_score", F.coalesce("ps_score", F.lit(NO_SCORE)))
    return closest_three(pairs, ["d_id"], PS1_FIELDS).withColumnRenamed("d_id", "id")


def closest_legacy(sources: DataFrame, north: DataFrame, south: DataFrame) -> DataFrame:
    """The three nearest survey neighbours per source and catalog half (``half`` is north or south)."""
    both = north.withColumn("half", F.lit("north")).unionByName(south.withColumn("half", F.lit("south")))
    pairs = cone_join(both, sources.select("id", "ra", "dec"), K.NEIGHBOR_RADIUS_DEG, b_prefix="s_")
    mags = {b: abmag(F.col(f"flux_{b}")) for b in LEGACY_BANDS}
    pairs = pairs.withColumns({"sep": F.col("sep_deg") * 3600, **mags})
    return closest_three(pairs, ["s_id", "half"], LEGACY_FIELDS).withColumnRenamed("s_id", "source_id")


def names_within(det: DataFrame, catalogs: dict[str, tuple[DataFrame, str]], size: int = 10_000) -> DataFrame:
    """(id, part, one column per field): names of catalog objects within 1.5 arcsec of each detection.

    ``catalogs`` maps a field to (catalog, name column); all are searched in one join.
    """
    everything = None
    for field, (catalog, column) in catalogs.items():
        part = catalog.select(F.col(column).alias("name"), "ra", "dec", F.lit(field).alias("field"))
        everything = part if everything is None else everything.unionByName(part)
    hits = cone_join(everything, det.select("id", "ra", "dec"), 1.5 * ARCSEC, b_prefix="d_")
    lists = distinct_names(hits.select(F.struct(F.col("d_id").alias("id"), "field").alias("key"), "name"), "key", "name", size)
    return lists.groupBy("key.id", "part").agg(
        *[F.max(F.when(F.col("key.field") == field, F.col("names"))).alias(field) for field in catalogs]
    )


def crossmatch_candidate(
    det: DataFrame, sources: DataFrame, ps1: DataFrame, scores: DataFrame, north: DataFrame, south: DataFrame,
    names: dict[str, tuple[DataFrame, str]], size: int = 10_000,
) -> DataFrame:
    """Catalog fields per detection ``(id, ra, dec, source_id)``.

    ``names`` maps an output field to (catalog, name column). Empty lists give an
    empty text. Name lists longer than ``size`` go on in further ``part`` rows.
    """
    half = F.when(F.col("dec") < HALF_DEC, "south").otherwise("north")
    base = det.select("id", "ra", "dec", "source_id", half.alias("half"))
    own = base.join(closest_ps1(det, ps1, scores), "id", "left")
    own = own.join(closest_legacy(sources, north, south), ["source_id", "half"], "left").drop("half", "ra", "dec", "source_id")
    out = own.join(names_within(base, names, size), "id", "left")
    # a detection without names has no list row; one whose list starts in a later part cannot exist
    return out.withColumns({"part": F.coalesce("part", F.lit(0)), **{f: F.coalesce(f, F.lit("")) for f in names}})
