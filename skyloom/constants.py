"""Values fixed by the survey's data products and detection rules."""

# --- fixed values: photometry and time ------------------------------------
MJD_TO_JD = 2400000.5
MAGERR_FACTOR = 1.08573620476
NANOMAGGY_ZP = 22.5
STACK_ZP = 25.0
STACK_BACKGROUND = 150.0
BIG_RMS_SQUARED = 50000.0
APERTURE_RADIUS_PIX = 3.0
QUALITY_RADIUS_PIX = 6.0
CUTOUT_SIZE = 63
MASK_BORDER = 10
SATURATION_FRACTION = 0.9

# --- fixed values: mask bits that make a pixel unusable --------------------
BAD_BITS = (0, 2, 3, 4, 5, 7, 8, 9, 10, 16, 17)
BAD_SUM = sum(1 << b for b in BAD_BITS)  # 198589
BIT_NO_DATA = 16
BIT_SUBTRACTION_MASKED = 17

# --- fixed values: filters and partition key -------------------------------
BANDS = {1: "zg", 2: "zr", 3: "zi"}
GROUP_KEY = ("field", "ccdid", "qid", "fid")
RB_CUT = {1: 0.3, 2: 0.3, 3: 0.6}
RB_UNSCORED = -99.0

# --- fixed values: association and stacking --------------------------------
ASSOC_RADIUS_DEG = 2.0 / 3600.0
ASSOC_RB_MIN = 0.4
NEIGHBOR_RADIUS_DEG = 30.0 / 3600.0
FOOTPRINT_RADIUS_DEG = 0.64
STACK_ORIGIN = "2017-01-03 00:00:00"
STACK_DAYS = 7
MAX_DETECTIONS = 50
REFERENCE_MAX_IMAGES = 50
REFERENCE_MIN_IMAGES = 14
JOB_SIZE = 960
RETRIEVAL_JOBS = 14

# --- fixed values: fields that get references -------------------------------
ACTIVE_FIELDS = (
    631, 762, 763, 722, 676, 724, 677, 761, 678, 720, 721, 679, 863,
    846, 823, 862, 845, 822, 793, 844, 759, 821, 719, 792, 758, 791,
)
