"""Names, word lists and thresholds that are part of the data contract."""

# Category flags, in feature order.
TARGET_CATEGORIES = ["cs.LG", "cs.AI", "cs.CV", "cs.CL"]

# Category order of the daily fetch; on duplicates the earliest category wins.
INGEST_PRIORITY = ["cs.LG", "cs.CV", "cs.AI", "cs.CL"]

# Title words, in feature order. Literal substrings of the lower-cased title.
BUZZWORDS = [
    "transformer", "diffusion", "agent", "multimodal", "rlhf",
    "llm", "mamba", "vision", "reasoning", "inference",
    "quantization", "scaling", "foundation", "eval",
]

METADATA_FEATURES = [
    "num_authors", "abstract_length", "title_length",
    "day_of_week", "month", "num_categories",
]
CATEGORY_FEATURES = ["cat_" + c.replace(".", "_") for c in TARGET_CATEGORIES]
BUZZWORD_FEATURES = ["buzz_" + w for w in BUZZWORDS]
AUTHOR_FEATURES = ["max_h_index", "total_prior_papers", "has_author_enrichment"]

# The 27 model inputs. The order is the contract with stored models.
FEATURE_COLS = METADATA_FEATURES + CATEGORY_FEATURES + BUZZWORD_FEATURES + AUTHOR_FEATURES

CHECKED_NONE = "checked_none"      # lookup id of "looked up, not found"
RECHECK_DAYS = 7                   # a checked_none paper younger than this is looked up again
ENRICHMENT_PREFIX = "arXiv:"       # key prefix of the enrichment batches
CURATION_START = "2024-01-01"
UPVOTE_THRESHOLD = 5               # preliminary label: more upvotes than this
STAR_THRESHOLD = 100               # ground-truth label: more stars than this
LABEL_LAG_DAYS = 60
DEFAULT_THRESHOLD = 0.8837         # decision threshold of a model without its own
MIN_CURRENT_ROWS = 30              # fewer current rows: no drift report
REFERENCE_ROWS = 5000
PAPER_BATCH = 500
AUTHOR_BATCH = 1000

FEED_DAYS, FEED_LIMIT, FEED_MAX_LIMIT = 30, 50, 200
CLIENT_MAX_DAYS, CLIENT_LIMIT, PAGE_SIZE = 90, 100, 10
TIERS = ["hype", "likely", "low"]

# Code points of Unicode White_Space, as trimmed from feed text.
WHITE_SPACE = "".join(map(chr, [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))
# Whitespace as trimmed from repository URLs: the above and four separators.
URL_WHITE_SPACE = WHITE_SPACE + "".join(map(chr, [0x1C, 0x1D, 0x1E, 0x1F]))

# Colour steps of the dashboards: (lower bound, colour), first without bound.
BANDS = {
    "mean_score": [(None, "blue"), (0.1, "green"), (0.3, "orange")],
    "drift_share": [(None, "green"), (0.2, "yellow"), (0.5, "red")],
    "feature_drift": [(None, "green"), (0.1, "yellow"), (0.3, "red")],
}
