"""Workload constants.

Fixed values: these must equal the original pipeline's for the same results.

- feature dimension of every model: 30000
- size of the ranked top-K catalog: 30000
- item-id prefix carried by the main install table: "11"
- train / validation split: 80 / 20
- default decision threshold: 0.5, a tuned threshold is accepted within 0.5 +/- 0.05
- feature token layout: "[" + item id + "_" + item name + "]_wind_" + index + ":" + value
- install token layout: item id + ":" + count, tokens separated by one space
- output files per written partition in the original jobs: 10
- logistic regression: maxIter 100, tol 1e-6, regParam 0.0, no intercept
- sample job date: 20180709
"""

FEATURE_DIM = 30000
TOP_K = 30000
# A catalog size that leaves items of the sample catalog out.
SMALL_K = 500
ITEM_PREFIX = "11"
TRAIN_PERCENT = 80
DEFAULT_THRESHOLD = 0.5
THRESHOLD_TOLERANCE = 0.05
TOKEN_OPEN = "["
TOKEN_NAME_SEP = "_"
TOKEN_INDEX_SEP = "]_wind_"
INDEX_MARKER = "_wind_"
VALUE_SEP = ":"
LIST_SEP = " "
ORIGINAL_FILES_PER_PARTITION = 10
LR_MAX_ITER = 100
LR_TOL = 1e-6
LR_REG_PARAM = 0.0
LR_FIT_INTERCEPT = False
SAMPLE_JOB_DATE = 20180709

# Size bounds that gate broadcasts and single-task steps. A side is broadcast
# only after a count proves it is at most this many rows and bytes.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20
# Bounds of a catalog lookup that every task holds as a whole (about 1.3 times its
# bytes in each Python worker). Beyond them, as many of the most installed items as the
# same bounds allow are held, and the others are joined to chunks of install rows
# with at most CHUNK_TOKENS tokens.
LOOKUP_MAX_ROWS = 4_000_000
LOOKUP_MAX_BYTES = 256 << 20
CHUNK_TOKENS = 1 << 20
# Rows of an input join that one task sorts; beyond them both sides are dealt out by the
# join key into as many partitions as that asks for.
JOIN_ROWS_PER_PARTITION = 1 << 20
# Most rows one task may merge for an ordered top-k (partitions x k).
TOPK_MAX_MERGE_ROWS = 2_000_000
# Buckets of the daily feature table (100 TB: about 24 GB of features a bucket; a
# cluster's table is created with the count that suits its size).
FEATURE_BUCKETS = 4_096
# Rows of the histogram that finds a top-k cut-off.
HISTOGRAM_BUCKETS = 1_024
# Training rows per partition (sparse rows of a few hundred nonzeros).
TRAIN_ROWS_PER_PARTITION = 250_000
# Shuffle join of the catalog lookup: a key with more than one in HOT_KEYS of all
# tokens is hot; the sketch that finds them tracks this many keys.
HOT_KEYS = 1_000
HOT_KEYS_TRACKED = 10_000
# Cluster sessions without their own shuffle sizing: shuffles start this wide
# and AQE merges neighbouring partitions up to the advisory size, so a 100 TB
# input never lands in the default 200 partitions.
CLUSTER_INITIAL_SHUFFLE_PARTITIONS = 32_768
CLUSTER_ADVISORY_PARTITION_BYTES = "256m"
