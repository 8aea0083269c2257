"""Fixed values.

Everything in this module is a value that results depend on: names that appear
in stored tables, thresholds, and word lists. All thresholds are also keyword
arguments of the operators that use them.
"""

# Language tags a review may carry.
LANGUAGE_HINTS = ["yue", "zh-Hant", "zh-Hans", "en", "mixed", "unknown"]

# Run phases, in order.
PHASES = ["crawl", "load", "layer1", "layer2", "audit", "analyze"]

# Rule-filter outcomes, highest priority first.
EXCLUSION_REASONS = ["non_five_star", "too_short", "pure_logistics", "pass"]

# The seven seed slots.
SEED_CATEGORIES = [
    "personal_trial",
    "skin_result",
    "repurchase",
    "social_proof",
    "value_for_money",
    "brand_comparison",
    "packaging_care",
]

# Human label vocabulary.
HUMAN_LABELS = ["shill", "not_shill", "unsure"]
LABEL_STRATA = ["near_seed", "far_seed", "genuine_long", "logistics_edge"]

# Scorer vocabulary.
LINGUISTIC_STYLES = [
    "canned_pr",
    "fake_oral_cantonese",
    "genuine_oral",
    "mixed_code_switch",
    "formal_written_chinese",
    "english_heavy",
    "unknown",
]
SIGNAL_CODES = [
    "STOCK_PRAISE",
    "NO_PRODUCT_SPECIFICS",
    "TEMPLATE_OPENER",
    "TEMPLATE_CLOSER",
    "FAKE_ORALITY",
    "SOCIAL_PROOF_CLICHE",
    "REPURCHASE_CLICHE",
    "BRAND_COMPARE_CLICHE",
    "CP_VALUE_CLICHE",
    "PACKAGING_PRAISE_ONLY",
    "SKIN_RESULT_VAGUE",
    "URGENCY_MARKETING",
    "GENUINE_DETAIL",
    "GENUINE_FLAW_MENTION",
]
UNLISTED_TEMPLATE = "unlisted_template"
MAX_ATTEMPTS = 6

# Row-key prefix.
REVIEW_ID_VERSION = "v1"
MIN_SALT_CHARS = 16

# Query keys that carry no identity in a URL (besides utm_*).
TRACKING_QUERY_KEYS = [
    "gclid",
    "gbraid",
    "wbraid",
    "dclid",
    "fbclid",
    "msclkid",
    "twclid",
    "ttclid",
    "li_fat_id",
    "mc_cid",
    "mc_eid",
    "igshid",
    "yclid",
    "ysclid",
    "_ga",
    "_gl",
    "_gac",
    "_gid",
]

# Keys that must never appear in a stored review.
FORBIDDEN_KEYS = [
    "reviewer_id_raw",
    "cookie",
    "Cookie",
    "authorization",
    "Authorization",
]

# Cantonese particles that decide the language tag.
YUE_PARTICLES = "嘅喺唔咗係"

# Characters that count as white space in review text.
WHITESPACE = (
    "\t\n\u000b\u000c\r\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# A starting list of phrases about delivery and packaging; callers keep their own.
DELIVERY_PHRASE_VERSION = "starter-1"
DELIVERY_PHRASES = {
    "shipping_speed": ["arrived early", "arrived on time", "quick shipping", "shipped quickly", "came the next day", "速遞準時", "當日送達", "隔天送達"],
    "packaging": ["nicely wrapped", "box was intact", "sealed properly", "包得很穩妥", "盒子沒有壓壞"],
    "courier": ["the courier was polite", "left at the door", "快遞員有禮貌", "放在門口"],
    "generic_thanks": ["thanks to the seller", "will open it later", "謝謝店家", "還沒打開"],
}

# Rule filter.
REQUIRED_STARS = 5
MIN_TEXT_CHARS = 25

# Distances, scores, vectors.
SEED_DISTANCE_THRESHOLD = 0.28
STORE_PAIR_DISTANCE_THRESHOLD = 0.20
SCORE_THRESHOLD = 75
VECTOR_WIDTH = 768

# Volume bursts.
BASELINE_DAYS = 14
MIN_BASELINE_BUCKETS = 5
DAY_MIN_Z = 3.0
DAY_MIN_REVIEWS = 10
HOUR_MIN_REVIEWS = 8
HOUR_MIN_FIVE_STAR_SHARE = 0.9

# Funnel tightness of stage2 / raw.
FUNNEL_LOOSE_ABOVE = 0.15
FUNNEL_TIGHT_BELOW = 0.01

# Calibration grid and the tokens assumed per scored review.
DISTANCE_GRID = [0.18, 0.22, 0.25, 0.28, 0.32, 0.38]
ASSUMED_INPUT_TOKENS = 900
ASSUMED_OUTPUT_TOKENS = 250

# Price per million tokens by model family. A family is "model
# name contains `has`, and does not contain `lacks` where that is given".
MODEL_PRICES = [
    {"has": "3.5-flash", "lacks": "lite", "input_per_m": 1.5, "output_per_m": 9.0},
    {"has": "3.1-flash-lite", "lacks": None, "input_per_m": 0.25, "output_per_m": 1.5},
]

# Score histogram labels.
SCORE_BINS = ["0-24", "25-49", "50-74", "75-100"]

# Crawl pages hold this many reviews.
REVIEWS_PER_PAGE = 10
REVIEW_UTC_OFFSET = "+08:00"

# Why a review block on a page could not be read, first failing wins.
PAGE_REJECT_REASONS = [
    "missing_review_id",
    "missing_reviewer_id",
    "star_rating",
    "empty_comment",
    "bad_date",
]
# Texts that carry a pager total and a declared review count.
PAGE_TOTAL_PATTERN = r"共\s*(\d+)\s*頁"
DECLARED_REVIEWS_PATTERN = r"(\d+)\s*則評論"
