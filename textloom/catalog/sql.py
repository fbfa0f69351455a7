"""Building blocks of the check SQL (DuckDB)."""

from __future__ import annotations

from textloom.functions import fixed
from textloom.functions.language import LANGUAGES, NAMED, UNKNOWN, hit_words, stop_words

SPACE = fixed.SPACE_CLASS
_LETTER = r"\p{L}\p{M}*"
WORD = (
    rf"_*(?:(?:{_LETTER}(?:[''’.:·]?{_LETTER})*|\p{{N}}(?:[''’.,;]?\p{{N}})*)_*)+"
)


def quoted(words) -> str:
    return "(" + ",".join("'" + word.replace("'", "''") + "'" for word in words) + ")"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def decoded(text: str) -> str:
    """The entities of the test pages; like all old ones they need no semicolon."""
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = f"regexp_replace({text}, '&{name};?', '{char}', 'g')"
    return text


def cleaned(text: str) -> str:
    kept = rf"regexp_replace({text}, '[^a-zA-Z0-9À-ÿ''’\-.,;!?(){SPACE}]', '', 'g')"
    return rf"trim(regexp_replace({kept}, '[{SPACE}]+', ' ', 'g'))"


def keyword_cleaned(text: str) -> str:
    no_links = rf"regexp_replace(lower({text}), 'http[^{SPACE}]+', '', 'g')"
    return rf"regexp_replace({no_links}, '[^a-zàâçéèêëîïôûùüÿñæœ{SPACE}]', '', 'g')"


def words(text: str) -> str:
    """Keyword tokens of cleaned text."""
    split = rf"string_split_regex({text}, '[{SPACE}]+')"
    halves = (
        "list_transform({}, lambda w: CASE w WHEN 'cannot' THEN ['can','not'] "
        "WHEN 'gimme' THEN ['gim','me'] WHEN 'gonna' THEN ['gon','na'] "
        "WHEN 'gotta' THEN ['got','ta'] WHEN 'lemme' THEN ['lem','me'] "
        "WHEN 'wanna' THEN ['wan','na'] ELSE [w] END)"
    ).format(split)
    return f"list_filter(flatten({halves}), lambda w: w <> '')"


def title_of(html: str) -> str:
    return strip(decoded(f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)(</title>|$)', 1)"))


def content_of(html: str, dropped: str = "") -> str:
    scripts = (
        rf"regexp_replace({html}, '(?is)<script[^>]*>.*?(</script[^>]*>|$)"
        rf"|<style[^>]*>.*?(</style[^>]*>|$)', '<x>', 'g')"
    )
    comments = rf"regexp_replace({scripts}, '(?s)<!--.*?(-->|$)', '<x>', 'g')"
    if dropped:
        comments = f"regexp_replace({comments}, '{dropped}', '<x>', 'g')"
    body = f"regexp_extract({comments}, '(?is)<body[^>]*>(.*)$', 1)"
    nodes = f"list_filter(string_split_regex({body}, '<[^>]*(>|$)'), lambda n: n <> '')"
    joined = f"array_to_string(list_transform({nodes}, lambda n: {decoded('n')}), ' ')"
    return strip(joined)


ITEMS = f"""
raw_items AS (
  SELECT page_id, url, {title_of('html')} AS raw_title, {content_of('html')} AS raw_content
  FROM pages),
clean_items AS (
  SELECT page_id, url, {cleaned('raw_title')} AS title, {cleaned('raw_content')} AS content
  FROM raw_items WHERE raw_content <> '' AND NOT contains(url, 'robots.txt')),
items AS (
  SELECT page_id AS doc_id, title, url, content FROM clean_items
  WHERE title <> '' AND url <> '' AND content <> '')"""


def language_cte(source: str) -> str:
    """``langs``: doc_id, lang of ``source`` (doc_id, content)."""
    found = r"regexp_extract_all(lower(content), '[\p{L}]+')"
    counts = ", ".join(
        f"len(list_filter(w, lambda x: x IN {quoted(hit_words(lang))})) AS {lang}"
        for lang in LANGUAGES
    )
    best = f"greatest({', '.join(LANGUAGES)})"
    cases = " ".join(
        f"WHEN {lang} = {best} THEN '{lang if lang in NAMED else UNKNOWN}'" for lang in LANGUAGES
    )
    return f"""
hits AS (SELECT doc_id, {counts} FROM (SELECT doc_id, {found} AS w FROM {source}) q),
langs AS (SELECT doc_id, CASE WHEN {best} = 0 THEN '{UNKNOWN}' {cases} END AS lang FROM hits)"""


def terms_cte(source: str) -> str:
    """``terms``: doc_id, lang, terms of ``source``."""
    cases = " ".join(
        f"WHEN lang = '{lang}' THEN list_filter(w, lambda x: len(x) > 1 AND x NOT IN "
        f"{quoted(stop_words(lang))})"
        for lang in NAMED
    )
    return f"""{language_cte(source)},
tokens AS (SELECT doc_id, {words(keyword_cleaned('content'))} AS w FROM {source}),
terms AS (
  SELECT doc_id, lang, CASE {cases} ELSE list_filter(w, lambda x: len(x) > 1) END AS terms
  FROM tokens JOIN langs USING (doc_id))"""


def keywords_cte(source: str) -> str:
    """``tf``, ``vocabulary``, ``weights`` and ``ranked`` of ``source``."""
    return f"""{terms_cte(source)},
tf AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(terms) AS term FROM terms) q GROUP BY ALL),
corpus AS (SELECT count(*) AS n FROM {source}),
vocabulary AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
  HAVING count(*) >= {fixed.MIN_DOC_FREQ}
     AND count(*) <= {fixed.MAX_DOC_SHARE} * (SELECT n FROM corpus)),
weights AS (
  SELECT doc_id, term, tf, df, tf * (ln((1.0 + n) / (1.0 + df)) + 1.0) AS weight
  FROM tf JOIN vocabulary USING (term), corpus),
ranked AS (
  SELECT * FROM (
    SELECT doc_id, term, weight,
      row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term DESC) AS rank
    FROM weights) q WHERE rank <= {fixed.KEYWORDS_PER_DOC})"""


def analyzed(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}')"


DOCS = "docs AS (SELECT doc_id, text AS content FROM documents)"

FETCH_LOG = """
log AS (
  SELECT event_id AS fetch_id,
    'https://u' || user_id || '.example.com/p'
      || (CAST(json_extract_string(props, '$.k') AS INT) % 10) AS url,
    CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 503
      WHEN 'purchase' THEN CASE WHEN value < 10 THEN 404 WHEN value < 30 THEN 403 ELSE 410 END
      WHEN 'error' THEN CASE WHEN value < 10 THEN 500 WHEN value < 20 THEN 429
        WHEN value < 40 THEN 408 ELSE 401 END END AS status,
    CASE WHEN event_type = 'signup'
      THEN CASE WHEN value < 5 THEN 'TypeError' ELSE 'TimeoutError' END END AS exception
  FROM events),
classed AS (
  SELECT *, coalesce(exception, CAST(status AS VARCHAR)) AS error_code,
    CASE WHEN exception IN ('TimeoutError', 'TCPTimedOutError', 'DNSLookupError',
        'ConnectionRefusedError', 'ResponseFailed') THEN 'retry'
      WHEN exception IS NOT NULL THEN 'ignore'
      WHEN status IN (403, 404, 406) THEN 'fail'
      WHEN status IN (500, 502, 503, 504, 408, 429) THEN 'retry' ELSE 'ok' END AS outcome
  FROM log),
runs AS (
  SELECT *, count(*) FILTER (outcome <> 'retry') OVER (PARTITION BY url ORDER BY fetch_id) AS run
  FROM classed),
turns AS (
  SELECT *, row_number() OVER (PARTITION BY url, run ORDER BY fetch_id) AS turn
  FROM runs WHERE outcome = 'retry'),
spent AS (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetch_id) AS nth FROM turns WHERE turn = 6),
exhausted AS (SELECT url AS failed_url, error_code FROM spent WHERE nth = 1),
at_once AS (
  SELECT DISTINCT url AS failed_url, error_code FROM classed WHERE outcome = 'fail')"""

VISITED = """
processed AS (
  SELECT url FROM pages JOIN events ON user_id = page_id
  WHERE event_type = 'view' AND value > 40),
failed AS (
  SELECT url AS failed_url, '503' AS error_code FROM pages JOIN events ON user_id = page_id
  WHERE event_type = 'error' AND value > 60)"""
