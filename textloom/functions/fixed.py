"""Results depend on these exact lists and numbers."""

# Boilerplate markers looked for inside id and class attributes.
EXCLUDE_KEYWORDS = (
    "header", "footer", "nav", "aside", "navigation", "sidebar", "ads",
    "advertisement", "schema", "jsonld", "ld+json", "microdata",
    "structured-final_data",
)

# Link patterns and path extensions that are never followed.
DENY_PATTERNS = (
    r"/robots\.txt$",
    r"/sitemap\.xml$",
    r"/sfuser/.*",
    r"/connexion$",
    r"/inscription$",
    r"/mentions-legales$",
    r"/aide$",
    r"/faq$",
    r"/infolettres$",
)
DENY_EXTENSIONS = ("txt", "xml", "pdf", "zip")
LINK_SCHEMES = ("http", "https", "file", "ftp")
MAX_URL_LENGTH = 2083

# How a fetch outcome is classified.
FAIL_STATUS = (403, 404, 406)
RETRY_STATUS = (500, 502, 503, 504, 408, 429)
RETRY_EXCEPTIONS = (
    "TimeoutError", "TCPTimedOutError", "DNSLookupError",
    "ConnectionRefusedError", "ResponseFailed",
)
MAX_RETRIES = 5

# Keyword extraction.
MIN_DOC_FREQ = 5
MAX_DOC_SHARE = 0.9
KEYWORDS_PER_DOC = 10

# Search.
BM25_K1 = 1.2
BM25_B = 0.75
PAGE_SIZE = 10
PAGE_CAP = 27
SNIPPET_CHARS = 200
DEFAULT_TITLE = "No Title"
DEFAULT_URL = "#"
DEFAULT_CONTENT = "No Content"

# Every character Python counts as whitespace, as the inside of a
# character class both Java and RE2 read.
SPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Messages of refused requests and configurations.
EMPTY_QUERY = "No terms entered."
UNKNOWN_SINK = "Non-supported type : Choose either 's3' or 'local'"
