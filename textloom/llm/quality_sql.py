"""DuckDB SQL for the quality rules, step for step."""

from __future__ import annotations

from textloom.llm import quality as Q

_WORD = r"[^\x20\x09-\x0D]+"
_P = 5
_CELLS = [(i, j) for i in range(_P) for j in range(i + 1)]


def _quantile(name: str, rows: str, keys: str, value: str, share: float) -> str:
    """CTE ``name``: the least value up to which ``share`` of a group's rows lie."""
    return f"""
{name} AS (
  SELECT {keys}, min(v) AS limit_, any_value(t) AS t FROM (
    SELECT {keys}, v, sum(n) OVER (PARTITION BY {keys} ORDER BY v) AS c,
      sum(n) OVER (PARTITION BY {keys}) AS t
    FROM (SELECT {keys}, {value} AS v, count(*) AS n FROM {rows} GROUP BY ALL))
  WHERE c >= {share} * t GROUP BY {keys})"""


def _measured(name: str, estimate: str) -> str:
    y = []
    for i in range(_P):
        terms = "".join(f" - l{i}{k} * y{k}" for k in range(i))
        y.append(f"(x{i} / {Q.UNIT} - m{i}{terms}) / l{i}{i} AS y{i}")
    d2 = " + ".join(["0.0::DOUBLE", *[f"y{i} * y{i}" for i in range(_P)]])
    xs = ", ".join(f"x{i}" for i in range(_P))
    return f"""
{name} AS (
  SELECT r, g, {xs}, d2, floor(log2(d2 + 1e-6) * {Q.FINE}) AS level FROM (
    SELECT r, g, {xs}, {", ".join(y)}, {d2} AS d2 FROM good JOIN {estimate} USING (g)))"""


def _estimate(name: str, core: str) -> str:
    unit = Q.UNIT * Q.UNIT
    sums = [f"sum(x{i}) AS s{i}" for i in range(_P)] + [f"sum(x{i} * x{j}) AS q{i}{j}" for i, j in _CELLS]
    cov = [
        f"(q{i}{j} / n - (s{i} / n) * (s{j} / n)) / {unit}"
        + (f" + {Q.FLOOR * Q.FLOOR}::DOUBLE" if i == j else "") + f" AS c{i}{j}"
        for i, j in _CELLS
    ]
    factor = []
    for i, j in _CELLS:
        inner = f"c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        least = Q.FLOOR * Q.FLOOR / 4
        factor.append(
            f"sqrt(greatest({inner}, {least}::DOUBLE)) AS l{i}{j}" if i == j
            else f"({inner}) / l{j}{j} AS l{i}{j}"
        )
    means = [f"s{i} / n / {Q.UNIT} AS m{i}" for i in range(_P)]
    return f"""
{name} AS (
  SELECT g, {", ".join(means)}, {", ".join(cov)}, {", ".join(factor)}
  FROM (SELECT g, count(*) AS n, {", ".join(sums)} FROM {core} GROUP BY g))"""


def query() -> str:
    steps, estimate = [], "start"
    for k in range(Q.STEPS):
        steps += [
            _measured(f"d_{k}", estimate),
            _quantile(f"limit_{k}", f"d_{k}", "g", "level", Q.CORE),
            f"\ncore_{k} AS (SELECT d_{k}.* FROM d_{k} JOIN limit_{k} USING (g) WHERE level <= limit_)",
            _estimate(f"estimate_{k}", f"core_{k}"),
        ]
        estimate = f"estimate_{k}"
    steps += [_measured("d_end", estimate), _quantile("middle", "d_end", "g", "level", 0.5)]
    normal = _P * (1 - 2 / (9 * _P)) ** 3
    start_m = ", ".join(f"max(limit_) FILTER (dim = {i}) AS m{i}" for i in range(_P))
    start_a = ", ".join(f"sum(abs(x{i} - m{i})) AS a{i}" for i in range(_P))
    start_l = ", ".join(
        f"a{i} / n / {Q.UNIT} + {Q.FLOOR}::DOUBLE AS l{i}{j}" if i == j else f"0.0::DOUBLE AS l{i}{j}"
        for i, j in _CELLS
    )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    [coalesce('=' || lang, ''), coalesce('=' || source, '')] AS g FROM documents),
spots AS (
  SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '{_WORD}') AS ws FROM docs)),
grams AS (
  SELECT r, i, x, lead(x, 1) OVER w AS y, lead(x, 2) OVER w AS z FROM spots
  WINDOW w AS (PARTITION BY r ORDER BY i)),
counted AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) AS c FROM grams WHERE z IS NOT NULL),
marked AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM counted WHERE c > 1) GROUP BY r),
said AS (
  SELECT r, doc_id, g, len(regexp_extract_all(text, '{_WORD}')) AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines,
    coalesce(marked.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN marked USING (r)),
stats AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines, greatest(n_words, 1) AS n,
    n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM said),
good AS (
  SELECT r, g,
    CAST(round(ln(n) * {Q.UNIT}) AS BIGINT) AS x0,
    CAST(round(4 * ln((word_chars + 1) / n) * {Q.UNIT}) AS BIGINT) AS x1,
    CAST(round(4 * sqrt(n_symbols / n) * {Q.UNIT}) AS BIGINT) AS x2,
    CAST(round(2 * sqrt(n_dup_lines / n) * {Q.UNIT}) AS BIGINT) AS x3,
    CAST(round(2 * sqrt(n_repeat_words / n) * {Q.UNIT}) AS BIGINT) AS x4
  FROM stats WHERE NOT base_failed),
every AS (
  SELECT g, unnest([0, 1, 2, 3, 4]) AS dim, unnest([x0, x1, x2, x3, x4]) AS x FROM good),
{_quantile("medians", "every", "g, dim", "x", 0.5)},
centers AS (SELECT g, {start_m} FROM medians GROUP BY g),
spread AS (SELECT g, count(*) AS n, {start_a} FROM good JOIN centers USING (g) GROUP BY g),
start AS (
  SELECT g, {", ".join(f"m{i} / {Q.UNIT} AS m{i}" for i in range(_P))}, {start_l}
  FROM centers JOIN spread USING (g)),
{",".join(steps)},
judged AS (
  SELECT r, CASE WHEN t >= {Q.LEAST_GROUP} THEN
      d2 * ({normal}::DOUBLE / greatest(pow(2.0::DOUBLE, limit_ / {Q.FINE}), {normal}::DOUBLE)) END AS d2
  FROM d_end JOIN middle USING (g))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(d2 <= {Q.CUT * _P}, true) AS kept
FROM stats LEFT JOIN judged USING (r)
"""
