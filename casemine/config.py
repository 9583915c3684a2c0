"""Fixed values and default parameters.

Everything here is data, stated once in natural order.  The cleaning
characters, token patterns and model parameters are fixed values whose
meaning must stay as given for results to be right; the word lists and
templates are our own short lists in the documented one-entry-per-line form.
"""

from __future__ import annotations

# --- fixed values: text preparation -------------------------------------------------
# Characters deleted from text before it is split into tokens.
DELETED_CHARS = ",;)(}{+#*][|!`=\"?"
# Token separators: space, newline, tab, carriage return.
TOKEN_SPLIT = "[ \n\t\r]"
# One of each is stripped from the end of a token, in this order, then from the start.
STRIP_ORDER = [".", ":", ",", "~", "-"]
# Defaults for missing values.
DEFAULT_HISTORY = "no history"
DEFAULT_CAUSE = "no cause -- no sub cause"
DEFAULT_CUSTOMER = "no customer"
DEFAULT_HARDWARE = "no hardware"
DEFAULT_SOFTWARE = "no software"
UNKNOWN_PROBLEM = "unable to identify the problem"
UNKNOWN_SOLUTION = "unable to identify the solution"
PLATFORM_UNSET = "please specify"
PLATFORM_UNKNOWN = "unknown"
PACK_SEPARATOR = "--"

# --- fixed values: token patterns (a token is dropped when it matches in full) -------
TOKEN_PATTERNS = {
    "case_number": r"(\d{4})-(\d{4})-(\d{4})",
    "email": r"(\w+)@([\w\.]+)",
    "phone": r"([0-9]{1,3})[ -.]([0-9]{1,3})[ -.]([0-9]{4,10})",
    "number10": r"(\d{10})",
    "date": r"([1-9]|0[1-9]|1[012])[- /]([1-9]|0[1-9]|[12][0-9]|3[01])[- /.](\d{2}|\d{4})",
    "time": r"(0[1-9]|[12][0-9]):(\d{2}):(\d{2})",
    "short_time": r"(\d{1}|\d{2}):(\d{2})",
    "long_time": r"(0[1-9]|[12][0-9]):(\d{2}):(\d{2}).(\d{3})",
    "run": r"([.]{3,}|[>]{3,}|[-]{3,})",
    "tag": r"(<(.|\n)+?>)",
    "suffix_ed": r"\w*ed\b",
    "suffix_ly": r"\w*ly\b",
    "suffix_ing": r"\w*ing\b",
}
# Tokens starting with one of these are dropped (links); more can be passed in.
DROP_PREFIXES = ["http", "ftp"]

# --- own dictionaries (lower case, one entry each) ------------------------------------
STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and",
    "any", "are", "as", "at", "be", "because", "been", "before", "being", "below",
    "between", "both", "but", "by", "can", "could", "did", "do", "does", "doing",
    "down", "during", "each", "few", "for", "from", "further", "had", "has", "have",
    "having", "he", "her", "here", "hers", "herself", "him", "himself", "his", "how",
    "i", "if", "in", "into", "is", "it", "its", "itself", "just", "me",
    "more", "most", "my", "myself", "no", "nor", "not", "now", "of", "off",
    "on", "once", "only", "or", "other", "our", "ours", "ourselves", "out", "over",
    "own", "same", "she", "should", "so", "some", "such", "than", "that", "the",
    "their", "theirs", "them", "themselves", "then", "there", "these", "they", "this", "those",
    "through", "to", "too", "under", "until", "up", "very", "was", "we", "were",
    "what", "when", "where", "which", "while", "who", "whom", "why", "will", "with",
    "would", "you", "your", "yours", "yourself", "yourselves",
]
DOMAIN_STOP_WORDS = [
    "case", "customer", "issue", "please", "thanks", "thank", "regards", "hello", "hi", "team",
    "update", "status", "ticket", "support", "engineer", "call", "email", "mail", "note", "notes",
    "time", "today", "yesterday", "tomorrow", "week", "attached", "attachment", "log", "logs", "info",
]
NAMES_AND_MONTHS = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december", "jan", "feb", "mar", "apr", "jun", "jul", "aug",
    "sep", "sept", "oct", "nov", "dec", "monday", "tuesday", "wednesday", "thursday",
    "friday", "saturday", "sunday", "alice", "bob", "carol", "dave", "erin", "frank",
    "grace", "heidi", "ivan", "judy", "mallory", "oscar", "peggy", "trent", "victor", "walter",
]

# --- own templates: "<required> keywords <optional>" ---------------------------------
PROBLEM_TEMPLATES = [
    "<device> fails <after-upgrade>",
    "<session> drops <intermittently>",
    "<link> is down <since>",
    "<process> keeps restarting <itself>",
    "<traffic> is dropped <on-interface>",
    "<service> stopped responding <after-change>",
    "<error> appears in <logs>",
    "<unit> does not boot <anymore>",
    "<memory> usage is high <on-device>",
    "<alarm> raised for <component>",
    "<packets> are lost <between-sites>",
    "<login> is rejected <for-user>",
    "<core> file generated <on-node>",
    "<route> is missing <from-table>",
    "<something> is the <problem>",
    "<something> of the <fault>",
]
SOLUTION_TEMPLATES = [
    "<issue> resolved by <action>",
    "<we> replaced the <part>",
    "<upgrade> fixed the <issue>",
    "<case> closed with <agreement>",
    "<workaround> is to <action>",
    "<config> change applied <successfully>",
    "<customer> confirmed the <fix>",
    "<reboot> cleared the <condition>",
    "<patch> installed on <device>",
    "<engineer> provided the <steps>",
    "<problem> no longer <seen>",
    "<root> cause was <found>",
    "<ticket> can be <closed>",
    "<answer> is to <restart>",
    "<something> with the <fix>",
    "<something> and the <change>",
]

# --- fixed values: model parameters ----------------------------------------------------
PROBLEM_FRACTION = (1, 4)       # leading quarter of history lines
SOLUTION_FRACTION = (3, 4)      # lines from three quarters on
LDA_TOPICS = 2
LDA_ITERATIONS = 30
LDA_ALPHA_NUMERATOR = 50        # alpha = 50 / k, integer division
LDA_BETA_NUMERATOR = 200        # beta = 200 / |V| + 1
TOPIC_TOP_FRACTION = 0.15
TOPIC_MIN_TERM_LENGTH = 3
FP_MIN_SUPPORT = 0.25
FP_SETS_SUPPORT = 0.15          # of the registered itemsets: low enough for sets of several items
FP_PATTERN_WEIGHT = 100
KMEANS_START_K = 20
KMEANS_K_STEP = 5
KMEANS_ITERATIONS = 20
NB_SMOOTHING = 1.0
WEIGHT_COUNT_CAP = 9
LONG_WORD_LENGTH = 7
HASH_SCALE = 4294967296.0       # 2^32: top 32 bits of md5 scaled to [0, 1)
STREAM_WINDOW = "5 minutes"
STREAM_SLIDE = "10 seconds"
STREAM_TRIGGER = "10 seconds"
STREAM_PARTITIONS = 2
