"""Fixed values.

Every value in this module must equal the catalogue/classifier behaviour this engine
reproduces; changing any of them changes results. They are kept together, in their
natural order, so they can be checked at a glance.
"""

# --- fixed values: catalogue attribute types -------------------------------------
ATTR_TYPE_CATEGORY = 708          # attribute holding the category text (training job)
ATTR_TYPE_DRESS_LENGTH = 10643    # attribute holding the dress-length text (export job)
PUBLISHED_STATE_ID = 2            # product state used by all three catalogue jobs

# --- fixed values: dress-length attribute text -> enum name ----------------------
DRESS_LENGTH_ENUM = {
    "Above the Knee": "AbovetheKnee",
    "Mini": "Mini",
    "Long/Maxi": "Long_Maxi",
    "Midi/Tea Length": "Midi_Tea_Length",
    "Knee Length": "KneeLength",
}
# enum declaration order (used for iteration / export order)
DRESS_LENGTH_ENUM_ORDER = ["AbovetheKnee", "KneeLength", "Midi_Tea_Length", "Long_Maxi", "Mini"]

# --- fixed values: image role -> size suffix -------------------------------------
IMAGE_ROLE_SUFFIX = {
    "CPRI": "214x261.jpg",
    "CSW": "214x214.jpg",
    "CADD": "214x261.jpg",
}
DEFAULT_ROLE = "CPRI"

# --- fixed values: sharded image URL layout --------------------------------------
URL_SHARD_DIGITS = 8              # last 8 digits of the id, zero padded, in pairs
URL_SHARD_MODULUS = 100_000_000   # 10 ** URL_SHARD_DIGITS
URL_FINAL_SEGMENT = "final/"

# --- fixed values: accepted predictions per source dress length (warning rule) ---
LENGTH_RULES = {
    "AbovetheKnee": ["short", "knee length", "high low"],
    "Mini": ["short"],
    "Long_Maxi": ["long"],
    "Midi_Tea_Length": ["below the knee", "high low"],
    "KneeLength": ["below the knee", "knee length", "high low"],
}

# --- fixed values: shipped label list (line index = class id) --------------------
SHIPPED_LABELS = ["below the knee", "high low", "short", "knee length", "long"]

# --- fixed values: colour palette of the colour check ----------------------------
COLOR_PALETTE = [
    "Black", "Blue", "Brown", "Gold", "Gray", "Green", "Ivory_Cream", "Multi", "Orange",
    "Pink", "Purple", "Red", "Silver", "White", "Yellow", "Tan_Beige",
]

# --- fixed values: image folder listing and split --------------------------------
IMAGE_EXTENSIONS = ["jpg", "jpeg", "JPG", "JPEG"]
SMALL_FOLDER_THRESHOLD = 20       # "< 20 images" warning
LABEL_NORMALIZE_PATTERN = "[^a-z0-9]+"
NOHASH_PATTERN = "_nohash_.*$"
HASH_BUCKETS = 65536              # sha1 mod 65536
HASH_SCALE = 100 / 65535.0        # percentage scale, a double
DEFAULT_VALIDATION_PCT = 10
DEFAULT_TESTING_PCT = 10

# --- fixed values: training defaults ---------------------------------------------
TRAINING_STEPS = 4000
LEARNING_RATE = 0.01
TRAIN_BATCH = 100
EVAL_INTERVAL = 10
VALIDATION_BATCH = 100
TEST_BATCH = 500
INIT_STDDEV = 0.001

# --- fixed values: scoring -------------------------------------------------------
TOP_K_LENGTH = 2
TOP_K_COLOR = 3
SCORE_DECIMALS = 2

# --- fixed values: JDBC partitioned scan -----------------------------------------
BUCKET_COLUMN = "id_mod"

# --- fixed values: dress-length export/check order -------------------------------
DRESS_LENGTH_CHECK_ORDER = ["AbovetheKnee", "Mini", "Long_Maxi", "Midi_Tea_Length", "KneeLength"]
