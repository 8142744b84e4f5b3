"""Fixed values.

The first block holds values whose exact text the results depend on (class
cut-offs and labels, referrer rules, bit masks). They are stated plainly and in
their natural order. The second block holds the synthetic names used to derive
test views from the given tables; they carry no meaning beyond the tests.
"""

# --- fixed values (results depend on them) --------------------------------

# Scoring class: first matching cut wins, NULL or anything lower is 'bad'.
SCORING_CUTS = [(20, "star"), (15, "good"), (10, "average")]
SCORING_DEFAULT = "bad"
SCORING_ORDER = ["bad", "average", "good", "star"]

# Actor quality class on the average rating of the most recent year.
QUALITY_CUTS = [(8, "star"), (7, "good"), (6, "average")]
QUALITY_DEFAULT = "bad"

# Referrer grouping: ordered substring rules, first match wins, otherwise the
# original text is kept (NULL stays NULL). The two on-site rules take the
# site's own domains as a parameter (see ON_SITE_DOMAINS).
REFERRER_RULES = [
    ("linkedin", "Linkedin"),
    ("t.co", "Twitter"),
    ("google", "Google"),
    ("lnkd", "Linkedin"),
]
ON_SITE_LABEL = "On Site"

# Growth-accounting state labels.
STATE_NEW = "New"
STATE_RETAINED = "Retained"
STATE_RESURRECTED = "Resurrected"
STATE_CHURNED = "Churned"
STATE_STALE = "Stale"

# Player state change labels.
PLAYER_NEW = "New"
PLAYER_RETIRED = "Retired"
PLAYER_CONTINUED = "Continued Playing"
PLAYER_RETURNED = "Returned from Retirement"
PLAYER_STAYED_RETIRED = "Stayed Retired"

# 32-day activity bits: bit (31 - d) is set when the entity was active d days
# before the snapshot day. Masks over that layout:
MASK_LAST_7_DAYS = 0xFE000000       # bits 31..25 = days 0..6
MASK_PREVIOUS_7_DAYS = 0x01FC0000   # bits 24..18 = days 7..13
MASK_32_BITS = 0xFFFFFFFF

# Graph enums.
VERTEX_TYPES = ["player", "team", "game"]
EDGE_TYPES = ["plays_against", "shares_team", "plays_in", "plays_on"]

# Signup exposure and conversion urls of the experiment read-out.
EXPOSURE_URL = "/signup"
CONVERSION_URL = "/api/v1/user"

# --- synthetic names for views derived from the given tables --------------

HOSTS = ["www.site-one.io", "site-two.tech", "shop.site-one.io"]
ON_SITE_DOMAINS = ["site-one", "site-two"]
REFERRERS = [
    "https://www.linkedin.com/feed/",
    "https://t.co/x1",
    "https://www.google.com/search",
    "https://lnkd.in/x2",
    "https://www.site-one.io/blog",
    "https://site-two.tech/",
    "https://www.reddit.com/r/dataengineering",
    None,
]
EXPERIMENT = "signup_button"
