"""The registered queries once more, as SQL for DuckDB."""

from __future__ import annotations

from storyloom.lexicons import (
    CHART_STOP_WORDS,
    LEMMA_SUFFIXES,
    LEMMAS,
    RESPONSE_CATEGORIES,
    SENTIMENT_LABELS,
    STOP_WORDS,
)
from storyloom.operators.profile import CORRELATED

from checks import adapter as a


def lit(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, float):
        return f"{value!r}e0"  # a DOUBLE, not a DECIMAL
    return str(value)


def row_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def replace_all(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)}, 'g')"


SPACE = (
    r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


# control and other non-text characters, but not tab, newline and space
CONTROL = r"[^\P{C}\t\n ]"
MASKS = r"\[MASK\]"


def matches(pattern: str, c: str) -> str:
    return f"len(regexp_extract_all({c}, {lit(pattern)}))"


def masked(c: str) -> str:
    return replace_all(c, r"\b[Xx]{2,}\b", "[MASK]")


def stripped(c: str) -> str:
    return replace_all(replace_all(c, r"https?://\S+|www\.\S+", ""), r"\S+@\S+", "")


def clean(c: str) -> str:
    return f"trim({replace_all(f'lower({stripped(masked(c))})', r'[^a-z\[\]]+', ' ')})"


def clean_basic(c: str) -> str:
    return f"trim({replace_all(stripped(masked(c)), SPACE, ' ')})"


def short_product(c: str) -> str:
    return f"substr(regexp_replace({c}, 'Credit reporting.*', 'Credit reporting', 'g'), 1, 35)"


def ellipsis(c: str, longer: int, keep: int) -> str:
    return f"CASE WHEN length({c}) > {longer} THEN substr({c}, 1, {keep}) || '…' ELSE {c} END"


def five_way(c: str, strong: float) -> str:
    n = [lit(x) for x in SENTIMENT_LABELS]
    return (
        f"CASE WHEN {c} <= {lit(-strong)} THEN {n[0]} WHEN {c} < -0.05e0 THEN {n[1]} "
        f"WHEN {c} <= 0.05e0 THEN {n[2]} WHEN {c} < {lit(strong)} THEN {n[3]} ELSE {n[4]} END"
    )


def bucket(c: str, low: float, high: float, bins: int) -> str:
    width = (high - low) / bins
    return f"least(greatest(floor(({c} - {lit(float(low))}) / {lit(width)}) + 1, 1), {bins})"


def lemma(w: str) -> str:
    return f"CASE {w} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in a.LEMMAS.items()) + f" ELSE {w} END"


CTES: dict[str, str] = {}

CTES["complaints"] = """
SELECT d.doc_id AS complaint_id, d.text AS narrative, d.source AS product, d.lang AS issue,
       'C' || CAST(d.doc_id * 13 % 11 AS VARCHAR) AS company, n.n_name AS state,
       CAST(DATE '2015-01-01' + CAST(d.doc_id * 37 % 3650 AS INTEGER) AS VARCHAR) AS date_received,
       CASE WHEN l.doc_id IS NULL THEN NULL
            WHEN l.quality = 1 AND l.toxic = 0 THEN 'Closed with explanation'
            WHEN l.quality = 1 THEN 'Closed with monetary relief'
            WHEN l.toxic = 1 THEN 'Untimely response' ELSE 'In progress' END AS response,
       CASE WHEN d.doc_id % 9 = 0 THEN 'No' ELSE 'Yes' END AS timely
FROM documents d
LEFT JOIN labels l ON l.doc_id = d.doc_id
LEFT JOIN nation n ON n.n_nationkey = d.doc_id % 27"""

CTES["redacted"] = f"""
SELECT complaint_id, {replace_all('narrative', a.REDACT, 'XXXX')} AS narrative FROM complaints"""

CTES["kept"] = """
SELECT *, length(narrative) AS narrative_length, year(CAST(date_received AS DATE)) AS year,
       month(CAST(date_received AS DATE)) AS month
FROM complaints WHERE coalesce(length(narrative), 0) >= 20"""

CTES["cleaned"] = f"SELECT complaint_id, {clean('narrative')} AS clean FROM kept"

CTES["words_long"] = """
SELECT complaint_id, unnest(ws) AS token, generate_subscripts(ws, 1) - 1 AS pos
FROM (SELECT complaint_id, list_filter(string_split_regex(clean, '[^a-z]+'), lambda w: w <> '') AS ws FROM cleaned)"""

CTES["tok"] = f"""
SELECT complaint_id, list_filter(
         list_transform(string_split_regex(clean, '[^a-z]+'), lambda w: {lemma('w')}),
         lambda w: length(w) >= 2 AND w NOT IN {row_list(a.STOP)}) AS tokens
FROM cleaned"""

CTES["tokens_flat"] = "SELECT t.complaint_id, unnest(t.tokens) AS token FROM tok t"

# RE2's \b is ASCII only, so other letters and digits become word characters first.
_ASCII = r"regexp_replace(narrative, '[^\x00-\x7F\P{L}]|[^\x00-\x7F\P{N}]', '_', 'g')"
_VERSION, _CARD, _IP = r"(?i:version)\s+\d+(?:\.\d+)*", r"\d{16}", r"\d{1,3}(?:\.\d{1,3}){3}"
_ANY = rf"\b(?:Apache License|MIT License|ononst|inoran|Rewh|Than|Is|{_VERSION}|{_CARD}|{_IP})\b"
CTES["ent"] = f"""
SELECT DISTINCT complaint_id, entity,
       CASE WHEN entity IN ('MIT License', 'Apache License') THEN 'LAW'
            WHEN entity IN ('Rewh', 'Than', 'Is') THEN 'ORG'
            WHEN entity IN ('ononst', 'inoran') THEN 'GPE'
            WHEN regexp_full_match(entity, {lit(_VERSION)}) THEN 'LAW'
            WHEN regexp_full_match(entity, {lit(_CARD)}) THEN 'MONEY' ELSE 'NET' END AS label
FROM (SELECT complaint_id, unnest(regexp_extract_all({_ASCII}, {lit(_ANY)})) AS entity FROM kept)"""

CTES["ent_counts"] = """
SELECT k.complaint_id, count(e.entity) AS entity_count,
       count(e.entity) FILTER (e.label = 'ORG') AS org_count,
       count(e.entity) FILTER (e.label = 'LAW') AS law_count,
       count(e.entity) FILTER (e.label = 'MONEY') AS money_count,
       count(e.entity) FILTER (e.label = 'GPE') AS gpe_count
FROM kept k LEFT JOIN ent e USING (complaint_id) GROUP BY k.complaint_id"""


def _lexicon_rows() -> str:
    x = a.LEXICON
    rows = []
    for term in sorted({*x.valence, *x.tone, *x.boosters, *x.intensity, *x.negations}):
        polarity, subjectivity = x.tone.get(term, (None, None))
        values = [x.valence.get(term), x.boosters.get(term), polarity, subjectivity, x.intensity.get(term)]
        shown = ", ".join("NULL::DOUBLE" if v is None else lit(float(v)) for v in values)
        rows.append(f"({lit(term)}, {shown}, {'true' if term in x.negations else 'false'})")
    return ", ".join(rows)


CTES["lex"] = f"""
SELECT * FROM (VALUES {_lexicon_rows()})
  t(term, valence, booster, polarity, subjectivity, intensity, negation)"""

CTES["spoken"] = f"""
SELECT complaint_id, unnest(ws) AS raw, generate_subscripts(ws, 1) - 1 AS i
FROM (SELECT complaint_id,
             list_filter(string_split_regex(narrative, {lit(SPACE)}), lambda w: w <> '') AS ws FROM kept)"""

CTES["word"] = f"""
SELECT complaint_id, i, w, lower(w) AS lw, (w = upper(w) AND w <> lower(w)) AS up
FROM (SELECT complaint_id, i, CASE WHEN length(trim(raw, {lit(PUNCTUATION)})) <= 2 THEN raw
                                   ELSE trim(raw, {lit(PUNCTUATION)}) END AS w FROM spoken)"""

CTES["doc_words"] = f"""
SELECT complaint_id, count(*) AS n_words, (count_if(up) > 0 AND count_if(up) < count(*)) AS caps,
       min(i) FILTER (lw = {lit(a.LEXICON.contrast)}) AS contrast
FROM word GROUP BY complaint_id"""

_LAGS = ", ".join(
    f"lag({c}, {k}) OVER w AS {n}{k}"
    for k in (1, 2, 3)
    for c, n in (
        ("w.lw", "w"), ("w.up", "u"), ("x.valence", "v"), ("x.booster", "b"),
        ("coalesce(x.negation, false) OR contains(w.lw, 'n''t')", "g"), ("x.intensity", "t"),
    )
)
CTES["marked"] = f"""
SELECT w.complaint_id, w.i, w.lw, w.up, x.valence, x.booster, x.polarity, x.subjectivity,
       lead(w.lw, 1) OVER w AS next_w, lead(x.valence, 1) OVER w AS next_v, {_LAGS}, d.caps, d.contrast
FROM word w JOIN doc_words d USING (complaint_id) LEFT JOIN lex x ON x.term = w.lw
WINDOW w AS (PARTITION BY w.complaint_id ORDER BY w.i)"""

CTES["step0"] = """
SELECT *, CASE WHEN caps AND up THEN CASE WHEN s > 0 THEN s + 0.733e0 ELSE s - 0.733e0 END ELSE s END AS a0
FROM (SELECT *, CASE WHEN coalesce(w1 = 'no' OR w2 = 'no' OR (w3 = 'no' AND w1 IN ('or', 'nor')), false)
                     THEN valence * -0.74e0
                     WHEN coalesce(lw = 'no' AND next_v IS NOT NULL, false) THEN 0e0 ELSE valence END AS s
      FROM marked WHERE valence IS NOT NULL AND booster IS NULL
        AND NOT coalesce(lw = 'kind' AND next_w = 'of', false))"""


def _step(k: int) -> str:
    j, v = k + 1, f"a{k}"
    scalar = f"(CASE WHEN {v} < 0 THEN -b{j} ELSE b{j} END)"
    loud = f"(CASE WHEN caps AND u{j} THEN CASE WHEN {v} > 0 THEN {scalar} + 0.733e0 ELSE {scalar} - 0.733e0 END ELSE {scalar} END)"
    boost = f"coalesce({loud} * {lit((1.0, 0.95, 0.9)[k])}, 0e0)"
    plain = f"CASE WHEN coalesce(g{j}, false) THEN -0.74e0 ELSE 1e0 END"
    so = lambda n: f"coalesce(w{n} IN ('so', 'this'), false)"
    factor = {
        0: plain,
        1: f"CASE WHEN coalesce(w2 = 'never', false) AND {so(1)} THEN 1.25e0 "
           f"WHEN coalesce(w2 = 'without' AND w1 = 'doubt', false) THEN 1e0 ELSE {plain} END",
        2: f"CASE WHEN (coalesce(w3 = 'never', false) AND {so(2)}) OR {so(1)} THEN 1.25e0 "
           f"WHEN coalesce(w3 = 'without' AND (w2 = 'doubt' OR w1 = 'doubt'), false) THEN 1e0 ELSE {plain} END",
    }[k]
    return f"SELECT *, CASE WHEN i > {k} AND v{j} IS NULL THEN ({v} + {boost}) * ({factor}) ELSE {v} END AS a{j} FROM step{k}"


for _k in range(3):
    CTES[f"step{_k + 1}"] = _step(_k)

CTES["valued"] = """
SELECT complaint_id, v * CASE WHEN contrast IS NULL THEN 1e0 WHEN i < contrast THEN 0.5e0
                              WHEN i > contrast THEN 1.5e0 ELSE 1e0 END AS v
FROM (SELECT *, CASE WHEN coalesce(w1 = 'least' AND v1 IS NULL, false)
                      AND NOT coalesce(w2 IN ('at', 'very'), false) THEN a3 * -0.74e0 ELSE a3 END AS v
      FROM step3)"""

CTES["sums"] = """
SELECT k.complaint_id, coalesce(d.n_words, 0) AS n_words, coalesce(x.s, 0e0) AS s, coalesce(x.p, 0e0) AS p,
       coalesce(x.n, 0e0) AS n, coalesce(d.n_words, 0) - coalesce(x.c, 0) AS z,
       least(length(narrative) - length(replace(narrative, '!', '')), 4) * 0.292e0
       + CASE WHEN q <= 1 THEN 0e0 WHEN q <= 3 THEN q * 0.18e0 ELSE 0.96e0 END AS e
FROM (SELECT *, length(narrative) - length(replace(narrative, '?', '')) AS q FROM kept) k
LEFT JOIN doc_words d USING (complaint_id)
LEFT JOIN (SELECT complaint_id, sum(v) AS s, sum(v + 1) FILTER (v > 0) AS p, sum(v - 1) FILTER (v < 0) AS n,
                  count(*) FILTER (v <> 0) AS c FROM valued GROUP BY complaint_id) x USING (complaint_id)"""

CTES["valence"] = """
SELECT complaint_id, round(s / sqrt(s * s + 15e0), 4) AS vader_compound,
       CASE WHEN n_words > 0 THEN round(-n / (p - n + z), 3) ELSE 0e0 END AS vader_neg,
       CASE WHEN n_words > 0 THEN round(z / (p - n + z), 3) ELSE 1e0 END AS vader_neu,
       CASE WHEN n_words > 0 THEN round(p / (p - n + z), 3) ELSE 0e0 END AS vader_pos
FROM (SELECT complaint_id, n_words, s + sign(s) * e AS s, CASE WHEN p > -n THEN p + e ELSE p END AS p,
             CASE WHEN p < -n THEN n - e ELSE n END AS n, z FROM sums)"""

CTES["tone"] = """
SELECT k.complaint_id, coalesce(x.p, 0e0) AS textblob_polarity, coalesce(x.s, 0e0) AS textblob_subjectivity
FROM kept k LEFT JOIN (
  SELECT complaint_id,
         avg(greatest(-1e0, least(1e0, polarity * f)) * CASE WHEN neg THEN -0.5e0 ELSE 1e0 END) AS p,
         avg(least(1e0, subjectivity * f)) AS s
  FROM (SELECT *, CASE WHEN neg THEN 1e0 / f0 ELSE f0 END AS f
        FROM (SELECT m.*, coalesce(t1, 1e0) AS f0,
                     coalesce(n1, false) OR (t1 IS NOT NULL AND coalesce(n2, false)) AS neg
              FROM (SELECT m.*, l1.negation AS n1, l2.negation AS n2 FROM marked m
                    LEFT JOIN lex l1 ON l1.term = m.w1 LEFT JOIN lex l2 ON l2.term = m.w2) m
              WHERE polarity IS NOT NULL))
  GROUP BY complaint_id) x USING (complaint_id)"""

CTES["sent"] = f"""
SELECT *, {five_way('vader_compound', 0.5)} AS vader_label, {five_way('textblob_polarity', 0.3)} AS textblob_label
FROM valence JOIN tone USING (complaint_id)"""

_LEGAL = " + ".join(f"CAST(contains(lower(narrative), {lit(t)}) AS BIGINT)" for t in a.LEGAL_TERMS)
CTES["feat"] = rf"""
SELECT k.complaint_id, len(t.tokens) AS word_count, len(list_distinct(t.tokens)) AS unique_words,
       len(list_distinct(t.tokens)) / CAST(len(t.tokens) + 1 AS DOUBLE) AS lexical_diversity,
       {_LEGAL} AS legal_term_count,
       length(regexp_replace(narrative, '\P{{Lu}}', '', 'g')) / CAST(length(narrative) + 1 AS DOUBLE) AS uppercase_ratio,
       len(regexp_extract_all(narrative, '\[MASK\]')) AS mask_count
FROM kept k JOIN tok t USING (complaint_id)"""

CTES["enriched"] = """
SELECT * FROM kept JOIN tok USING (complaint_id) JOIN ent_counts USING (complaint_id)
JOIN sent USING (complaint_id) JOIN feat USING (complaint_id)"""


def sql(body: str) -> str:
    """The body after the CTEs it needs, in order."""
    import re

    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"\b[a-z_0-9]+\b", text):
            if word in CTES and word not in needed:
                # names are also used as aliases, so only those read from count
                if re.search(rf"\b(?:FROM|JOIN)\s+{word}\b", text):
                    visit(CTES[word])
                    if word not in needed:
                        needed.append(word)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def top(col: str, k: int | None, table: str = "complaints", name: str | None = None, shown: str | None = None) -> str:
    limit = f"ORDER BY count(*) DESC, {col} LIMIT {k}" if k else ""
    return (
        f"SELECT {shown or col} AS {name or col}, {big('n', 'n')} FROM (SELECT {col}, count(*) AS n FROM {table} "
        f"WHERE {col} IS NOT NULL GROUP BY {col} {limit})"
    )


def describe(measure: str, expr: str, table: str) -> str:
    return f"""SELECT {lit(measure)} AS measure, {big('count(x)', '"count"')}, {r6('avg(x)', 'mean')}, {r6('stddev_samp(x)', 'std')},
       {r6('CAST(min(x) AS DOUBLE)', '"min"')}, {r6('quantile_cont(x, 0.25)', 'q25')}, {r6('quantile_cont(x, 0.5)', 'median')},
       {r6('quantile_cont(x, 0.75)', 'q75')}, {r6('CAST(max(x) AS DOUBLE)', '"max"')}
FROM (SELECT CAST({expr} AS DOUBLE) AS x FROM {table})"""


def hist(expr: str, low: float, high: float, bins: int, table: str, by: str = "", where: str = "true", extra: str = "") -> str:
    b = bucket(expr, low, high, bins)
    cols = f"{by}, " if by else ""
    width = (high - low) / bins
    return (
        f"SELECT {cols}{big('bin', 'bin')}, {big('count(*)', 'n')}, "
        f"{r6(f'{lit(float(low))} + (bin - 1) * {lit(width)}', 'edge')}{extra} "
        f"FROM (SELECT {cols}{b} AS bin FROM {table} WHERE {expr} IS NOT NULL AND {where}) GROUP BY {cols}bin"
    )


def entity_top(label: str, noise=(), names: dict | None = None) -> str:
    e = "trim(entity)"
    shown = e
    if names:
        shown = f"CASE {e} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in names.items()) + f" ELSE {e} END"
    skip = f"AND {e} NOT IN {row_list(noise)}" if noise else ""
    return (
        f"SELECT entity, {big('n', 'n')} FROM (SELECT {shown} AS entity, count(*) AS n FROM ent "
        f"WHERE label = {lit(label)} {skip} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)"
    )


def weights(table: str, k: int, where: str = "true") -> str:
    return (
        f"SELECT token, {big('n', 'n')}, {r6('n / CAST(max(n) OVER () AS DOUBLE)', 'weight')} "
        f"FROM (SELECT token, count(*) AS n FROM {table} WHERE {where} GROUP BY token ORDER BY n DESC, token LIMIT {k})"
    )


RANK = "md5(CAST(complaint_id AS VARCHAR) || ':42')"


def suffix(w: str) -> str:
    out = w
    for pattern, replacement in reversed(LEMMA_SUFFIXES):
        by = replacement.replace("$1", "\\1")
        out = f"CASE WHEN regexp_matches({w}, {lit(pattern)}) THEN regexp_replace({w}, {lit(pattern)}, {lit(by)}) ELSE {out} END"
    return out


# Narratives with the second of two equal words dropped, and how many were. In a run of equal words every other one goes.
UNDOUBLED = r"""(WITH p AS (SELECT complaint_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM
        (SELECT complaint_id, regexp_extract_all(narrative, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS ps FROM complaints WHERE narrative IS NOT NULL)),
      w AS (SELECT *, coalesce(regexp_full_match(p, '[A-Za-z]+') AND lag(p, 1) OVER o = ' ' AND lag(p, 2) OVER o = p, false) AS again
            FROM p WINDOW o AS (PARTITION BY complaint_id ORDER BY i)),
      -- a run goes on over the blanks between its words
      r AS (SELECT *, sum(CASE WHEN again OR NOT regexp_matches(p, '^[\p{L}\p{N}_]') THEN 0 ELSE 1 END) OVER (PARTITION BY complaint_id ORDER BY i) AS run FROM w),
      d AS (SELECT *, again AND count_if(again) OVER (PARTITION BY complaint_id, run ORDER BY i) % 2 = 1 AS gone FROM r),
      g AS (SELECT *, gone OR coalesce(lead(gone) OVER (PARTITION BY complaint_id ORDER BY i), false) AS dropped FROM d),
      t AS (SELECT complaint_id, coalesce(string_agg(p, '' ORDER BY i) FILTER (NOT dropped), '') AS undoubled, count_if(gone) AS n_doubled FROM g GROUP BY complaint_id)
   SELECT complaint_id, narrative, coalesce(undoubled, '') AS undoubled, CAST(coalesce(n_doubled, 0) AS BIGINT) AS n_doubled
   FROM complaints LEFT JOIN t USING (complaint_id))"""


def _quality(source: str = "complaints", text: str = "narrative", first: str = "") -> str:
    fixed = replace_all(replace_all(replace_all(text, "  +", " "), " +,", ","), "!!+", "!")
    n = lambda p: matches(p, "narrative")
    kinds = (
        f"list_concat(list_transform(range({n('  +')}), lambda z: 'doubled_space'), "
        f"list_concat(list_transform(range({n(' +,')}), lambda z: 'space_before_comma'), "
        f"list_transform(range({n('!!+')}), lambda z: 'repeated_mark')))"
    )
    kinds = f"list_concat({first}, {kinds})" if first else kinds
    empty = "trim(narrative) = ''"
    return f"""SELECT complaint_id, CASE WHEN {empty} THEN narrative ELSE {fixed} END AS texto_corregido,
       {big(f"CASE WHEN {empty} THEN 0 ELSE len({kinds}) END", 'cantidad_errores')},
       CASE WHEN {empty} THEN '' ELSE array_to_string({kinds}, ',') END AS tipos_errores
FROM {source} WHERE narrative IS NOT NULL"""


def _corr() -> str:
    parts = []
    for i, x in enumerate(CORRELATED):
        for y in CORRELATED[i + 1 :]:
            c = f"corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))"
            parts.append(f"SELECT {lit(x)} AS a, {lit(y)} AS b, CASE WHEN isnan({c}) THEN NULL ELSE round({c}, 6) END AS r FROM enriched")
    return "\nUNION ALL ".join(parts)


CHART = f"token NOT IN {row_list(CHART_STOP_WORDS)}"
ORDER = "CASE vader_label " + " ".join(f"WHEN {lit(x)} THEN {i + 1}" for i, x in enumerate(SENTIMENT_LABELS)) + " END"
CHOSEN = f"vader_label IN ({lit(SENTIMENT_LABELS[0])}, {lit(SENTIMENT_LABELS[2])}, {lit(SENTIMENT_LABELS[4])})"
SENT_COLUMNS = (
    "complaint_id, round(vader_compound, 4) AS vader_compound, vader_neg, vader_neu, vader_pos, vader_label, "
    + r6("textblob_polarity", "textblob_polarity") + ", " + r6("textblob_subjectivity", "textblob_subjectivity")
    + ", textblob_label"
)
FEATURE_COLUMNS = ", ".join(
    [big("word_count", "word_count"), big("unique_words", "unique_words"), r6("lexical_diversity", "lexical_diversity"),
     big("legal_term_count", "legal_term_count"), r6("uppercase_ratio", "uppercase_ratio"), big("mask_count", "mask_count")]
)
DATE_MIX = (
    "CASE WHEN complaint_id % 7 = 0 THEN 'unknown' WHEN complaint_id % 5 = 0 "
    "THEN strftime(CAST(date_received AS DATE), '%m/%d/%Y') ELSE date_received END"
)
FILTERED = "year >= 2016 AND year <= 2023 AND product IN ('src1', 'src3', 'src14') AND issue IN ('en', 'fr')"

BODIES: dict[str, str] = {
    "clean_text": f"SELECT complaint_id, {clean('narrative')} AS clean FROM complaints",
    "clean_basic": f"SELECT complaint_id, {clean_basic('narrative')} AS clean FROM redacted",
    "strip_control": f"SELECT complaint_id, {replace_all('narrative', CONTROL, '')} AS text FROM complaints",
    "mask_redactions": f"SELECT complaint_id, {masked('narrative')} AS text FROM redacted",
    "narrative_filter": f"SELECT complaint_id, {big('narrative_length', 'narrative_length')} FROM kept",
    "date_parts": f"""SELECT complaint_id, strftime(d, '%Y-%m-%d') AS day, {big('year(d)', 'year')}, {big('month(d)', 'month')}
FROM (SELECT complaint_id, coalesce(try_strptime(s, '%Y-%m-%d'), try_strptime(s, '%m/%d/%Y')) AS d
      FROM (SELECT complaint_id, {DATE_MIX} AS s FROM complaints))""",
    "short_labels": f"""SELECT complaint_id, {short_product("CASE WHEN complaint_id % 3 = 0 THEN 'Credit reporting, ' || product ELSE narrative END")} AS product_label,
       {ellipsis('narrative', 22, 22)} AS kpi_label, {ellipsis('narrative', 42, 40)} AS issue_label,
       {ellipsis('narrative', 32, 30)} AS response_label, {ellipsis('narrative', 250, 250)} AS cell FROM complaints""",
    "recode_response": "SELECT complaint_id, CASE response "
    + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in RESPONSE_CATEGORIES.items()) + " END AS category FROM complaints",
    "filter_options": " UNION ALL ".join(
        f"SELECT DISTINCT {lit(c)} AS \"column\", CAST({c} AS VARCHAR) AS value FROM kept WHERE {c} IS NOT NULL"
        for c in ("product", "issue", "state", "company", "year")
    ),
    "filtered_rows": f"SELECT complaint_id, product, issue, company, {big('year', 'year')} FROM kept WHERE {FILTERED}",
    "remove_word": r"SELECT complaint_id, regexp_replace(clean, '\bthe\b', '', 'g') AS text FROM cleaned",
    "clipped_lengths": f"SELECT complaint_id, {big('least(narrative_length, 5000)', 'clipped')} FROM kept",
    "tokens_long": f"SELECT complaint_id, {big('pos', 'pos')}, token FROM words_long",
    "lemmas_long": f"""SELECT complaint_id, {big('pos', 'pos')}, lemma FROM (SELECT complaint_id, pos, {lemma('token')} AS lemma FROM words_long)
WHERE length(lemma) >= 2 AND lemma NOT IN {row_list(a.STOP)}""",
    "suffix_lemmas": f"SELECT token, {suffix('token')} AS lemma, {big('count(*)', 'n')} FROM words_long GROUP BY token",
    "processed_text": f"SELECT complaint_id, array_to_string(tokens, ' ') AS processed_text, {big('len(tokens)', 'n_tokens')} FROM tok",
    "entities_long": "SELECT complaint_id, label, entity FROM ent",
    "entity_counts": "SELECT complaint_id, " + ", ".join(big(c, c) for c in ("entity_count", "org_count", "law_count", "money_count", "gpe_count")) + " FROM ent_counts",
    "entity_type_counts": f"SELECT complaint_id, label, {big('count(*)', 'n')} FROM ent GROUP BY complaint_id, label",
    "entity_normalise": f"""SELECT k.complaint_id, {big("count(e.entity) FILTER (e.label IN ('LAW', 'ORG') AND k.complaint_id % 5 <> 0)", 'n_kept')}
FROM kept k LEFT JOIN ent e USING (complaint_id) GROUP BY k.complaint_id""",
    "top_org": entity_top("ORG", a.ORG_NOISE),
    "top_law": entity_top("LAW", names=a.LAW_NAMES),
    "top_gpe": entity_top("GPE"),
    "top_entities_plain": f"SELECT 'ORG' AS label, * FROM ({entity_top('ORG')}) UNION ALL SELECT 'LAW' AS label, * FROM ({entity_top('LAW')})",
    "polarity": "SELECT complaint_id, vader_compound, vader_neg, vader_neu, vader_pos FROM valence",
    "polarity_label": "SELECT complaint_id, vader_label, textblob_label FROM sent",
    "subjectivity": f"SELECT complaint_id, {r6('textblob_polarity', 'textblob_polarity')}, {r6('textblob_subjectivity', 'textblob_subjectivity')} FROM tone",
    "sentiment_full": f"SELECT {SENT_COLUMNS} FROM sent",
    "text_features": f"SELECT complaint_id, {FEATURE_COLUMNS} FROM feat",
    "legal_terms": f"SELECT complaint_id, {big('legal_term_count', 'legal_term_count')} FROM feat",
    "mask_count": f"SELECT complaint_id, {big(matches(MASKS, 'narrative'), 'raw_masks')}, {big(matches(MASKS, masked('narrative')), 'masks')} FROM redacted",
}

BODIES |= {
    "null_profile": " UNION ALL ".join(
        f"SELECT * FROM (SELECT {lit(c)} AS \"column\", {big(f'count(*) FILTER ({c} IS NULL)', 'nulls')} FROM complaints) WHERE nulls > 0"
        for c in ("complaint_id", "narrative", "product", "issue", "company", "date_received", "timely", "state", "response")
    ),
    "duplicate_rows": f"""SELECT {big('count(*)', 'n_rows')}, {big('count(*) - count(DISTINCT (text, lang, source))', 'duplicates')} FROM documents""",
    "length_describe": describe("narrative_length", "length(narrative)", "complaints"),
    "length_stats": f"SELECT mean, std, \"min\", q25, median, q75, \"max\" FROM ({describe('length', 'length(narrative)', 'complaints')})",
    "length_flags": f"SELECT {big('count(*) FILTER (length(narrative) < 20)', 'n_short')}, {big('count(*) FILTER (length(narrative) > 3000)', 'n_long')} FROM complaints",
    "mask_share": f"SELECT {big('count(*) FILTER (x)', 'n_hit')}, {r6('avg(CAST(x AS INT)) * 100', 'pct_hit')} FROM (SELECT contains(lower(narrative), 'xxxx') AS x FROM redacted)",
    "date_range": "SELECT strftime(min(CAST(date_received AS DATE)), '%Y-%m-%d') AS first_date, strftime(max(CAST(date_received AS DATE)), '%Y-%m-%d') AS last_date FROM kept",
    "yearly": f"SELECT {big('year', 'year')}, {big('count(*)', 'n')} FROM kept GROUP BY year",
    "label_dist": f"SELECT 'vader_label' AS scorer, vader_label AS label, {big('count(*)', 'n')} FROM sent GROUP BY 2 UNION ALL SELECT 'textblob_label' AS scorer, textblob_label AS label, {big('count(*)', 'n')} FROM sent GROUP BY 2",
    "feature_describe": " UNION ALL ".join(
        f"SELECT * FROM ({describe(c, c, 'feat')})"
        for c in ("word_count", "unique_words", "lexical_diversity", "legal_term_count", "uppercase_ratio", "mask_count")
    ),
    "corr_matrix": _corr(),
    "top_issue": top("issue", 10),
    "top_product": top("product", 10),
    "response_dist": top("response", None),
    "timely_dist": top("timely", None),
    "term_weights": weights("tokens_flat", 200),
    "issue_term_weights": weights(
        "tokens_flat", 150,
        "complaint_id IN (SELECT complaint_id FROM kept WHERE issue = (SELECT issue FROM kept GROUP BY issue ORDER BY count(*) DESC, issue LIMIT 1))",
    ),
    "sample_uniform": f"SELECT complaint_id, product FROM kept ORDER BY {RANK}, complaint_id LIMIT 400",
    "sample_by_group": f"SELECT complaint_id, product FROM kept QUALIFY row_number() OVER (PARTITION BY product ORDER BY {RANK}, complaint_id) <= 3",
    "first_rows": "SELECT complaint_id, product FROM kept ORDER BY complaint_id LIMIT 500",
    "narrative_sample": "SELECT complaint_id, " + ", ".join(
        f"{ellipsis(c, 250, 250)} AS {c.split(' ')[0]}" for c in ("product", "issue", "company", "vader_label", "narrative")
    ) + f", strftime(CAST(date_received AS DATE), '%Y-%m-%d 00:00:00') AS date_received FROM (SELECT * FROM kept JOIN sent USING (complaint_id)) ORDER BY {RANK}, complaint_id LIMIT 8",
    "kpis": f"""SELECT {big('count(*)', 'n_rows')},
       {r6(f'avg(CAST(vader_label IN ({lit(SENTIMENT_LABELS[0])}, {lit(SENTIMENT_LABELS[1])}) AS INT)) * 100', 'negative_pct')},
       (SELECT {ellipsis('issue', 22, 22)} FROM (SELECT issue FROM kept GROUP BY issue ORDER BY count(*) DESC, issue LIMIT 1)) AS top_issue,
       (SELECT {ellipsis('company', 22, 22)} FROM (SELECT company FROM kept GROUP BY company ORDER BY count(*) DESC, company LIMIT 1)) AS top_company,
       {big('trunc(median(word_count))', 'median_tokens')},
       {r6('avg(CAST(legal_term_count > 0 AS INT)) * 100', 'legal_pct')} FROM enriched""",
    "kpis_empty": """SELECT count(*) AS n_rows, CAST(avg(CAST(vader_label LIKE '%Negativo' AS INT)) AS DOUBLE) AS negative_pct, coalesce(max(issue), '—') AS top_issue,
       coalesce(max(company), '—') AS top_company, CAST(median(word_count) AS BIGINT) AS median_tokens, CAST(avg(legal_term_count) AS DOUBLE) AS legal_pct
FROM enriched WHERE product = 'no such product'""",
    "funnel": f"""SELECT stage, {big('n', 'n')} FROM (
SELECT '1 raw' AS stage, (SELECT count(*) FROM complaints) AS n UNION ALL
SELECT '2 cleaned' AS stage, (SELECT count(*) FROM kept) AS n UNION ALL
SELECT unnest(['3 preprocessed', '4 entities and sentiment', '5 features']) AS stage, (SELECT count(*) FROM kept WHERE {FILTERED}) AS n)""",
    "timeline": f"SELECT {big('year', 'year')}, {big('count(*)', 'n')} FROM kept WHERE {FILTERED} GROUP BY year",
    "products": f"SELECT label, {big('sum(n)', 'n')} FROM (SELECT {short_product('product')} AS label, n FROM ({top('product', 8, 'kept')})) GROUP BY label",
    "issues": f"SELECT {ellipsis('issue', 42, 40)} AS label, n FROM ({top('issue', 10, 'kept')})",
    "states": top("state", 15, "kept"),
    "responses": f"SELECT {ellipsis('response', 32, 30)} AS label, n FROM ({top('response', 6, 'kept')})",
    "cloud_terms": weights("tokens_flat", 120, CHART),
    "top_tokens": f"SELECT token, {big('n', 'n')} FROM (SELECT token, count(*) AS n FROM tokens_flat WHERE {CHART} AND length(token) > 2 GROUP BY token ORDER BY n DESC, token LIMIT 20)",
    "sampled_tokens": f"SELECT token, {big('n', 'n')} FROM (SELECT token, count(*) AS n FROM tokens_flat WHERE {CHART} AND length(token) > 2 AND complaint_id IN (SELECT complaint_id FROM kept ORDER BY {RANK}, complaint_id LIMIT 300) GROUP BY token ORDER BY n DESC, token LIMIT 20)",
    "legal_freq": f"SELECT token, {big('count(*)', 'n')} FROM tokens_flat WHERE token IN {row_list(a.TOKEN_TERMS)} GROUP BY token",
    "hist_length": hist("least(narrative_length, 5000)", 0, 5000, 50, "kept", extra=", (SELECT round(median(narrative_length), 6) FROM kept) AS median"),
    "hist_diversity": hist("lexical_diversity", 0, 1, 40, "feat"),
    "hist_compound": hist("vader_compound", -1, 1, 60, "sent"),
    "hist_subjectivity": hist("textblob_subjectivity", 0, 1, 40, "sent", by="vader_label", where=CHOSEN),
    "box_words": f"""SELECT vader_label, round(q25, 6) AS q25, round(median, 6) AS median, round(q75, 6) AS q75, {big('count(*)', 'n')},
       CAST(min(v) FILTER (v BETWEEN q25 - 1.5e0 * (q75 - q25) AND q75 + 1.5e0 * (q75 - q25)) AS DOUBLE) AS low_fence,
       CAST(max(v) FILTER (v BETWEEN q25 - 1.5e0 * (q75 - q25) AND q75 + 1.5e0 * (q75 - q25)) AS DOUBLE) AS high_fence
FROM (SELECT *, quantile_cont(v, 0.25) OVER p AS q25, quantile_cont(v, 0.5) OVER p AS median, quantile_cont(v, 0.75) OVER p AS q75
      FROM (SELECT vader_label, CAST(word_count AS DOUBLE) AS v FROM enriched
            WHERE word_count <= (SELECT quantile_cont(CAST(word_count AS DOUBLE), 0.98) FROM feat))
      WINDOW p AS (PARTITION BY vader_label))
GROUP BY vader_label, q25, median, q75""",
    "label_order": f"SELECT vader_label, {big('count(*)', 'n')}, {big(ORDER, 'position')} FROM sent GROUP BY vader_label",
    "label_by_product": f"SELECT {short_product('product')} AS label, vader_label, {big('count(*)', 'n')} FROM enriched WHERE product IN (SELECT product FROM ({top('product', 8, 'kept')})) GROUP BY 1, 2",
    "label_by_year": f"SELECT {big('year', 'year')}, vader_label, {big('count(*)', 'n')} FROM enriched GROUP BY year, vader_label",
    "label_by_org": f"""SELECT entity, vader_label, {big('count(*)', 'n')} FROM ent JOIN sent USING (complaint_id)
WHERE label = 'ORG' AND entity IN (SELECT entity FROM ent WHERE label = 'ORG' AND entity NOT IN {row_list(a.ORG_NOISE)} GROUP BY entity ORDER BY count(*) DESC, entity LIMIT 8)
GROUP BY entity, vader_label""",
    "scorer_scatter": f"SELECT complaint_id, vader_compound, {r6('textblob_polarity', 'textblob_polarity')}, vader_label FROM sent ORDER BY {RANK}, complaint_id LIMIT 4000",
    "text_column": "SELECT 'narrative' AS \"column\" FROM region LIMIT 1",
    "mean_lengths": " UNION ALL ".join(
        f"SELECT {lit(c)} AS \"column\", {r6(f'avg(length({c}))', 'mean_length')} FROM complaints"
        for c in ("narrative", "product", "issue", "company", "date_received", "timely", "state", "response")
    ),
    "text_quality": _quality(),
    "text_quality_words": _quality(UNDOUBLED, "undoubled", "list_transform(range(n_doubled), lambda z: 'doubled_word')"),
    "csv_import": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents UNION ALL SELECT 'short-' || CAST(doc_id AS VARCHAR) AS doc_id, lang AS text, NULL AS lang, NULL AS source FROM documents",
    "stage_roundtrip": f"SELECT complaint_id, {FEATURE_COLUMNS} FROM feat",
    "incremental_enrich": f"SELECT complaint_id, {FEATURE_COLUMNS} FROM feat",
    "schema_listing": "SELECT CAST(i AS BIGINT) AS position, c AS \"column\", t AS type, (SELECT count(*) FROM documents) AS n_rows FROM (VALUES (0, 'doc_id', 'bigint'), (1, 'text', 'string'), (2, 'lang', 'string'), (3, 'source', 'string'), (4, 'n_chars', 'bigint')) t(i, c, t)",
    "csv_export": "SELECT CAST(complaint_id AS VARCHAR) AS complaint_id, array_to_string(tokens, ' ') AS tokens FROM tok",
    "lineitem_describe": " UNION ALL ".join(
        f"SELECT * FROM ({describe(name, c, 'lineitem')})"
        for name, c in (
            ("l_quantity", "l_quantity"), ("l_extendedprice", "l_extendedprice"),
            ("discount_pct", "l_discount * 100"), ("tax_pct", "l_tax * 100"),
        )
    ),
    "orders_yearly": f"SELECT {big('year(o_orderdate)', 'year')}, {big('count(*)', 'n')} FROM orders GROUP BY 1",
    "events_histogram": hist("value", 0, 1000, 50, "events", by="event_type"),
    "lineitem_top_parts": f"SELECT l_partkey, {big('n', 'n')} FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)",
    "orders_sample": "SELECT o_orderkey, o_orderpriority FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':7'), o_orderkey) <= 20",
}


# Words, those of at least 40 occurrences, and the best of these for every other one.
_CORRECTIONS = """(WITH w AS (SELECT word, count(*) AS n FROM
        (SELECT lower(unnest(regexp_extract_all(narrative, '[A-Za-z]+'))) AS word FROM complaints) GROUP BY word)
   SELECT u.word, k.word AS correction, levenshtein(u.word, k.word) AS distance
   FROM w u JOIN w k ON u.n < 40 AND k.n >= 40 AND length(u.word) >= 4 AND length(k.word) >= 2 AND abs(length(u.word) - length(k.word)) <= 2
   WHERE levenshtein(u.word, k.word) <= 2
   QUALIFY row_number() OVER (PARTITION BY u.word ORDER BY levenshtein(u.word, k.word), k.n DESC, k.word) = 1)"""
BODIES["spelling_corrections"] = f"SELECT word, correction, {big('distance', 'distance')} FROM {_CORRECTIONS}"
BODIES["spelling_texts"] = f"""SELECT complaint_id, md5(coalesce(string_agg(new, '' ORDER BY i), '')) AS text_md5, {big('count(correction)', 'cantidad_errores')} FROM
  (SELECT complaint_id, i, correction,
          CASE WHEN correction IS NULL THEN p WHEN p = upper(p) AND length(p) > 1 THEN upper(correction)
               WHEN p[1] = upper(p[1]) THEN upper(correction[1]) || correction[2:] ELSE correction END AS new
   FROM (SELECT complaint_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM
           (SELECT complaint_id, CASE WHEN narrative = '' THEN [''] ELSE regexp_extract_all(narrative, '[A-Za-z]+|[^A-Za-z]+') END AS ps
            FROM complaints WHERE narrative IS NOT NULL))
   LEFT JOIN {_CORRECTIONS} c ON c.word = lower(p)) GROUP BY complaint_id"""

# Texts without a record of too many fields; null texts are empty quoted ones or, where the concatenation is left out, no field.
BODIES["csv_split_import"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(NULL AS VARCHAR) AS lang, text, source FROM documents
UNION ALL SELECT 'short-' || CAST(doc_id AS VARCHAR), NULL, text, NULL FROM documents WHERE doc_id % 5 = 1"""
BODIES["span_entities"] = r"""
SELECT DISTINCT complaint_id, k.label AS label, k.text AS entity FROM
 (SELECT complaint_id, unnest(kept) AS k FROM
   (SELECT complaint_id, list_reduce(list({'kept': []::STRUCT(s BIGINT, e BIGINT, label VARCHAR, text VARCHAR)[], 's': s, 'e': e, 'label': label, 'text': text}
                                          ORDER BY s - e, s, label, text),
       lambda a, x: CASE WHEN len(list_filter(a.kept, lambda y: y.s < x.e AND x.s < y.e)) > 0 THEN a
                         ELSE {'kept': list_append(a.kept, {'s': x.s, 'e': x.e, 'label': x.label, 'text': x.text}), 's': x.s, 'e': x.e, 'label': x.label, 'text': x.text} END,
       {'kept': []::STRUCT(s BIGINT, e BIGINT, label VARCHAR, text VARCHAR)[], 's': 0::BIGINT, 'e': 0::BIGINT, 'label': '', 'text': ''}).kept AS kept
    FROM (WITH bw AS (SELECT regexp_extract_all(text, '[\p{L}\p{N}_]+') AS w FROM benchmark),
          ph AS (SELECT 'PAIR' AS label, w[i] || ' ' || w[i + 1] AS phrase FROM (SELECT w, unnest(range(1, len(w))) AS i FROM bw)
                 UNION SELECT 'TRIPLE', w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM bw)),
          pc AS (SELECT complaint_id, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM
                 (SELECT complaint_id, regexp_extract_all(coalesce(narrative, ''), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS ps FROM complaints)),
          t AS (SELECT *, coalesce(sum(length(p)) OVER (PARTITION BY complaint_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s,
                       p || lead(p, 1) OVER o || lead(p, 2) OVER o AS two, p || lead(p, 1) OVER o || lead(p, 2) OVER o || lead(p, 3) OVER o || lead(p, 4) OVER o AS three
                FROM pc WINDOW o AS (PARTITION BY complaint_id ORDER BY i))
          SELECT complaint_id, s, s + length(phrase) AS e, label, phrase AS text FROM t JOIN ph ON (label = 'PAIR' AND phrase = two)
          UNION ALL SELECT complaint_id, s, s + length(phrase), label, phrase FROM t JOIN ph ON (label = 'TRIPLE' AND phrase = three))
    GROUP BY complaint_id))"""
BODIES["lemma_table_tokens"] = f"""SELECT complaint_id, array_to_string(tokens, ' ') AS processed_text, {big('len(tokens)', 'n_tokens')} FROM
(SELECT complaint_id, list_filter(list_transform(string_split_regex(clean, '[^a-z]+'), lambda w: CASE WHEN length(w) > 6 THEN w[1:5] ELSE w END),
        lambda w: length(w) >= 2 AND w NOT IN {row_list(a.STOP)}) AS tokens FROM cleaned)"""
BODIES["default_tokens"] = f"""SELECT lemma AS token, {big('sum(n)', 'n')} FROM
(SELECT coalesce(t.lemma, {suffix('w.token')}) AS lemma, n FROM (SELECT token, count(*) AS n FROM words_long GROUP BY token) w
 LEFT JOIN (VALUES {", ".join(f"({lit(k)}, {lit(v)})" for k, v in LEMMAS.items())}) t(token, lemma) ON t.token = w.token)
WHERE length(lemma) >= 2 AND lemma NOT IN {row_list(STOP_WORDS)} GROUP BY lemma"""
# Runs 0 to 4: all stages; none; those from the table on; those from the sample on; all, over twice the rows.
BODIES["stage_changes"] = """SELECT CAST(run AS BIGINT) AS run, stage, CAST(n AS BIGINT) AS n FROM
(SELECT 0 AS run, unnest(['01_clean', '02_tokens', '03_entities', '04_sentiment', '05_features']) AS stage, (SELECT count(*) FROM kept) AS n
 UNION ALL SELECT 0, '00_raw', (SELECT count(*) FROM complaints)
 UNION ALL SELECT 2, '05_features', (SELECT count(*) FROM kept)
 UNION ALL SELECT 3, unnest(['01_clean', '02_tokens', '03_entities', '04_sentiment', '05_features']), (SELECT least(count(*), 200) FROM kept)
 UNION ALL SELECT 4, unnest(['01_clean', '02_tokens', '03_entities', '04_sentiment', '05_features']), (SELECT least(2 * count(*), 200) FROM kept)
 UNION ALL SELECT 4, '00_raw', (SELECT 2 * count(*) FROM complaints))"""


def _planted(side: int) -> str:
    return f"CASE complaint_id % {len(a.PLANTED)} " + " ".join(f"WHEN {i} THEN {lit(p[side])}" for i, p in enumerate(a.PLANTED)) + " END"


def _described(c: str) -> str:
    """Longest symbols first; a blank goes before a name unless one is there or the text begins, also where symbols touch."""
    for symbol in sorted(a.SYMBOLS, key=len, reverse=True):
        name = a.SYMBOLS[symbol]
        for _ in range(2):
            c = replace_all(c, f"([^ ]){symbol}", rf"\1 {name}")
        c = f"replace({c}, {lit(symbol)}, {lit(name)})"
    return c


PLANTED = _described(f"{_planted(0)} || narrative || {_planted(1)}")
BODIES["symbol_words"] = f"SELECT complaint_id, md5({PLANTED}) AS text_md5 FROM complaints"
ORACLES = {name: sql(body) for name, body in BODIES.items()}
ORACLES["symbol_valence"] = ORACLES["polarity"].replace(
    CTES["spoken"], CTES["spoken"].replace("FROM kept)", f"FROM (SELECT complaint_id, {PLANTED} AS narrative FROM kept))")
)
