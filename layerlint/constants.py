"""Fixed values of the domain: codes, labels, messages, histogram bounds, default limits.

Everything here is data that results must agree on, stated as is. Tunable values live in ``config``.
"""

# --- fixed values: error types, in the order their counters are listed -------------------------
VERTICES = "Vertices"
METADATA = "Metadata"
GEOMETRY_VALIDITY = "Geometry_Validity"
RESOLUTION = "Resolution"
SMALL_GEOMETRY = "Small_Geometry"
SMALL_HOLES = "Small_Holes"
UNKNOWN = "Unknown"

# (type, report column, counter)
ERROR_TYPES = [
    (VERTICES, "e_vertices", "vertices"),
    (METADATA, "e_metadata", "metadata"),
    (GEOMETRY_VALIDITY, "e_validity", "geometryValidity"),
    (RESOLUTION, "e_res", "resolution"),
    (SMALL_GEOMETRY, "e_sm_geom", "smallGeometries"),
    (SMALL_HOLES, "e_sm_holes", "smallHoles"),
    (UNKNOWN, "e_unknown", "unknown"),
]
COUNTERS = [counter for _, _, counter in ERROR_TYPES]
REPORT_COLUMNS = [column for _, column, _ in ERROR_TYPES]

# One error of these types alone makes a layer invalid; the two small_* types only do so above a share.
CRITICAL_COUNTERS = ["vertices", "metadata", "geometryValidity", "resolution", "unknown"]

# --- fixed values: messages -------------------------------------------------------------------
CHECKER_MESSAGES = {
    GEOMETRY_VALIDITY: "Invalid Geometry",
    RESOLUTION: "Resolution Conflict",
    SMALL_GEOMETRY: "Small geometry error",
    SMALL_HOLES: "Contains small holes",
    UNKNOWN: "Unknown error",
}
MESSAGE_SEPARATOR = "; "
UNKNOWN_ID = "UNKNOWN_ID"
DATE_MESSAGE = "Expected a valid date format (ISO 8601 or DD/MM/YYYY)"
SCALE_MESSAGE = "Scale must be a positive number"

# --- fixed values: summary document -----------------------------------------------------------
COUNT_LABELS = {
    "vertices": "Vertices limit error count",
    "metadata": "Metadata error count",
    "geometryValidity": "Geometry error count",
    "resolution": "Resolution error count",
    "smallGeometries": "Small geometries error count",
    "smallHoles": "Small holes error count",
    "unknown": "Unknown error count",
}
# Counters appear in the summary document in this order.
SUMMARY_COUNTERS = [
    "geometryValidity", "vertices", "metadata", "resolution", "smallGeometries", "smallHoles", "unknown",
]
THRESHOLD_LABELS = [
    ("smallGeometries", "Small geometries validation"),
    ("smallHoles", "Small holes validation"),
    ("resolution", "Resolution validation"),
]
SUMMARY_ABSTRACT = "Validation errors summary report"

# --- fixed values: layer files ----------------------------------------------------------------
LAYER_EXTENSIONS = [".shp", ".shx", ".dbf", ".prj", ".cpg"]
REPORTS_FOLDER = "validation-reports"

# --- fixed values: job routing and attempts ---------------------------------------------------
JOB_HANDLERS = {
    "Ingestion_New": "ingestion",
    "Ingestion_Update": "ingestion",
    "Ingestion_Swap_Update": "ingestion",
    "Export": "export",
}
MAX_ATTEMPTS = {"polygon-parts": 3, "validation": 3}
UNRECOVERABLE_ERRORS = ["UnrecoverableTaskError", "ReachedMaxTaskAttemptsError", "ShapefileNotFoundError"]
REACHED_MAX_ATTEMPTS = "ReachedMaxTaskAttemptsError"

# --- fixed values: histogram bounds (seconds or features) -------------------------------------
TASK_SECONDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 15, 50, 250, 500]
CHUNK_SECONDS = [0.001, 0.01, 0.05, 0.1, 0.5, 1, 2, 5, 10, 20, 30, 60]
CHUNK_FEATURES = [1, 10, 50, 100, 500, 1000, 5000, 10000]
FILE_SECONDS = [0.1, 1, 5, 10, 30, 60, 120, 300, 600, 1800, 3600]
FILE_FEATURES = [10, 100, 500, 1000, 5000, 10000, 50000, 100000]
# (largest chunk size, label); the last label has no upper end
CHUNK_SIZE_RANGES = [
    (100, "0-100"), (500, "101-500"), (1000, "501-1000"), (2000, "1001-2000"),
    (5000, "2001-5000"), (10000, "5001-10000"), (None, "10001+"),
]
