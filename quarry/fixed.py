"""These must equal the original programs' for equal results.
They are stated here once, in their natural order; modules import them."""

# --- Fixed values -------------------------------------------------------------
# Languages, in order; a language's position is its index (and coordinate).
LANGUAGES = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)

# k-means: spread between languages, number of centres, bound on the summed
# squared movement, round limit, sample seed; below GLOBAL_SAMPLE_SPREAD the
# seeds are drawn from all vectors instead of per language.
DEFAULT_SPREAD = 50000
DEFAULT_K = 45
DEFAULT_ETA = 20.0
DEFAULT_MAX_ITER = 120
DEFAULT_SEED = 42
GLOBAL_SAMPLE_SPREAD = 500

# Article line layout: characters before the title, the marker between title
# and text, characters after the text (wrapper content is not checked).
ARTICLE_PREFIX_LEN = 14
ARTICLE_MARKER = "</title><text>"
ARTICLE_SUFFIX_LEN = 16

# Activity column prefixes per class; a column goes to the first class it matches.
PRIMARY_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = ("t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14",
                  "t15", "t16", "t18")

# Recodes: working status 1 <= telfs < 3; male when tesex = 1; young up to 22,
# active up to 55, elder above; statuses above 4 are not employable; minutes
# per hour.
WORKING, NOT_WORKING = "working", "not working"
WORKING_MIN_STATUS, WORKING_MAX_STATUS = 1, 3
MALE_CODE = 1
MALE, FEMALE = "male", "female"
YOUNG, ACTIVE, ELDER = "young", "active", "elder"
YOUNG_MAX_AGE = 22
ACTIVE_MAX_AGE = 55
MAX_EMPLOYABLE_STATUS = 4
MINUTES_PER_HOUR = 60

# Cluster report: header lines, then per cluster the median score (7 wide),
# the dominant language (17 wide, left), its percent (one decimal, 5 wide,
# left) and the cluster size (7 wide).
REPORT_HEADER = (
    "Resulting clusters:",
    "  Score  Dominant language (%percent)  Questions",
    "================================================",
)
REPORT_LINE = "%7d  %-17s (%-5.1f%%)      %7d"
# -------------------------------------------------------------------------------
