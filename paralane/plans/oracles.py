"""The queries' results in SQL, written independently of the Spark code, for DuckDB."""

# Python's whitespace, zero-width characters and ASCII punctuation.
WS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
ZERO_WIDTH = r"[\x{200b}-\x{200f}\x{feff}]"
PUNCTUATION = "!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~"
LETTER = r"[\p{L}\p{Nl}\p{No}_]"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{WS}+'), lambda x: x <> '')"


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^{WS}+|{WS}+$', '', 'g')"


def normalize(text: str) -> str:
    bare = f"regexp_replace(nfc_normalize({text}), '{ZERO_WIDTH}', '', 'g')"
    return strip(f"regexp_replace({bare}, '{WS}+', ' ', 'g')")


def encoded(value: str) -> str:
    return f"coalesce(length(({value})::varchar)::varchar || ':' || ({value})::varchar, '-')"


def place(*keys: str) -> str:
    return f"sha256(concat_ws('|', '42', {', '.join(encoded(k) for k in keys)}))"


NAME = "CASE {0} WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE {0} END"
DISPLAY = f"{NAME.format('src_lang')} || ' -> ' || {NAME.format('tgt_lang')}"
KEY = "replace(replace({0}, ' ', '_'), '->', 'to')"

LINES = """
lines AS (
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents)"""

PAIRS = f"""{LINES},
pairs AS (
  SELECT a.doc_id, a.pos, a.line AS src, b.line AS tgt, a.lang AS src_lang, b.lang AS tgt_lang,
         a.source AS domain
  FROM lines a JOIN lines b ON b.doc_id = a.doc_id + 1 AND b.pos = a.pos)"""

COUNTED = f"""{PAIRS},
counted AS (SELECT *, len({words('src')}) AS sw, len({words('tgt')}) AS tw FROM pairs),
flagged AS (
  SELECT *,
    sw >= 3 AND tw >= 3 AS f1,
    sw <= 40 AND tw <= 40 AS f2,
    greatest(sw, tw)::double / greatest(least(sw, tw), 1) <= 3.5 AS f3,
    {strip('src')} <> {strip('tgt')} AS f4,
    regexp_matches(src, '{LETTER}') AND regexp_matches(tgt, '{LETTER}') AS f5,
    CASE WHEN tgt_lang NOT IN ('fr', 'de') THEN true
         WHEN length(replace({strip('tgt')}, ' ', '')) = 0 THEN false
         ELSE length(regexp_replace({strip('tgt')}, '[^A-Za-z]', '', 'g'))::double
              / length(replace({strip('tgt')}, ' ', '')) <= 0.93 END AS f6
  FROM counted),
tagged AS (
  SELECT *, CASE WHEN NOT f1 THEN 'min_length' WHEN NOT f2 THEN 'max_length'
    WHEN NOT f3 THEN 'length_ratio' WHEN NOT f4 THEN 'not_identical'
    WHEN NOT f5 THEN 'not_empty_or_numeric' WHEN NOT f6 THEN 'devanagari_ascii_ratio' END AS reason
  FROM flagged)"""

RULES = (
    "min_length", "max_length", "length_ratio", "not_identical", "not_empty_or_numeric",
    "devanagari_ascii_ratio",
)
REPORT = """
SELECT count(*) AS total_input, count(DISTINCT CASE WHEN reason IS NULL THEN src END) AS total_output,
  count(*) FILTER (reason = 'min_length') AS rejected_too_short,
  count(*) FILTER (reason = 'max_length') AS rejected_too_long,
  count(*) FILTER (reason = 'length_ratio') AS rejected_bad_ratio,
  count(*) FILTER (reason = 'not_identical') AS rejected_identical,
  count(*) FILTER (reason = 'not_empty_or_numeric') AS rejected_empty_numeric,
  count(*) FILTER (reason = 'devanagari_ascii_ratio') AS rejected_ascii_script,
  count(*) FILTER (reason IS NULL) - count(DISTINCT CASE WHEN reason IS NULL THEN src END)
    AS duplicates_removed,
  round(100.0 * count(DISTINCT CASE WHEN reason IS NULL THEN src END)
    / greatest(count(*), 1)::double, 1) AS retention_percent
FROM tagged"""


def first_of(table: str, key: str, order: str, columns: str) -> str:
    return f"""SELECT {columns} FROM {table}
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"""


# Scores: the n-grams of each row as rows of their own.

SCORED = f"""{PAIRS},
scored AS (
  SELECT *, array_to_string(list_transform(list_filter(list_zip(w, range(len(w))),
      lambda p: p[2] % 5 <> 4), lambda p: p[1]), ' ') AS prediction
  FROM (SELECT *, {words('tgt')} AS w FROM pairs))"""


def tokenized(text: str) -> str:
    t = f"regexp_replace({text}, '{WS}+$', '')"
    for old, new in (
        ("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"), ("'&quot;'", "'\"'"),
        ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'"),
    ):
        t = f"replace({t}, {old}, {new})"
    t = f"' ' || {t} || ' '"
    for pattern, new in (
        (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
        (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 "),
    ):
        t = f"regexp_replace({t}, '{pattern}', '{new}', 'g')"
    return words(t)


def pieces(text: str) -> str:
    return f"""flatten(list_transform({words(text)}, lambda w: CASE
      WHEN length(w) = 1 THEN [w]
      WHEN contains('{PUNCTUATION}', right(w, 1)) THEN [left(w, length(w) - 1), right(w, 1)]
      WHEN contains('{PUNCTUATION}', left(w, 1)) THEN [left(w, 1), substring(w, 2)]
      ELSE [w] END))"""


def _overlap(name: str, source: str, orders: int, length: str, gram: str) -> str:
    """Per row and order: n-grams of both sides and their clipped matches."""
    return f"""
{name}_grams AS (
  SELECT id, n, side, {gram} AS gram FROM (
    SELECT id, n, side, units, unnest(range(greatest({length} - n + 1, 0))) AS i
    FROM (SELECT id, 0 AS side, h AS units FROM {source} UNION ALL SELECT id, 1, r FROM {source}),
         range(1, {orders + 1}) AS o(n))),
{name}_counts AS (
  SELECT id, n, gram, count(*) FILTER (side = 0) AS hyp, count(*) FILTER (side = 1) AS ref
  FROM {name}_grams GROUP BY ALL),
{name} AS (
  SELECT id, n, sum(hyp)::bigint AS hyp, sum(ref)::bigint AS ref,
         sum(least(hyp, ref))::bigint AS hits
  FROM {name}_counts GROUP BY ALL)"""


LIST_GRAM = "array_to_string(units[i + 1:i + n], chr(1))"


def bleu(by: str, source: str = "scored") -> str:
    """CTEs that end in ``bleu(<by>, n_samples, bleu)``, unrounded."""
    return f"""
bleu_rows AS (
  SELECT row_number() OVER () AS id, {by}, {tokenized('prediction')} AS h, {tokenized('tgt')} AS r
  FROM {source}),{_overlap('bleu_overlap', 'bleu_rows', 4, 'len(units)', LIST_GRAM)},
bleu_orders AS (
  SELECT {by}, o.n, coalesce(sum(hits), 0)::double AS hits, coalesce(sum(hyp), 0)::double AS total
  FROM bleu_rows CROSS JOIN range(1, 5) AS o(n) LEFT JOIN bleu_overlap USING (id, n)
  GROUP BY ALL),
bleu_lengths AS (
  SELECT {by}, count(*) AS n_samples, sum(len(h))::double AS hyp_len, sum(len(r))::double AS ref_len
  FROM bleu_rows GROUP BY ALL),
bleu_smooth AS (
  SELECT {by}, n, hits, total, pow(2, count(*) FILTER (hits = 0)
      OVER (PARTITION BY {by} ORDER BY n)) AS k FROM bleu_orders),
bleu_logs AS (
  SELECT {by}, min(total) AS least_total, sum(hits) AS all_hits,
    sum(CASE WHEN total = 0 THEN 0 WHEN hits = 0 THEN ln(100.0 / (k * total))
        ELSE ln(100.0 * hits / total) END) AS logs
  FROM bleu_smooth GROUP BY ALL),
bleu AS (
  SELECT {by}, n_samples, CASE WHEN least_total = 0 OR all_hits = 0 THEN 0.0
    ELSE (CASE WHEN hyp_len >= ref_len THEN 1.0 ELSE exp(1 - ref_len / hyp_len) END) * exp(logs / 4)
    END AS bleu
  FROM bleu_logs JOIN bleu_lengths USING ({by}))"""


def chrf(by: str, source: str = "scored") -> str:
    """CTEs that end in ``chrf(<by>, n_samples, chrf_pp)``, unrounded."""
    hyp, ref = (f"regexp_replace({side}, '{WS}+', '', 'g')" for side in ("prediction", "tgt"))
    return f"""
chrf_rows AS (SELECT row_number() OVER () AS id, {by}, prediction, tgt FROM {source}),
chrf_chars AS (SELECT id, {hyp} AS h, {ref} AS r FROM chrf_rows),
chrf_words AS (SELECT id, {pieces('prediction')} AS h, {pieces('tgt')} AS r FROM chrf_rows),
{_overlap('char_overlap', 'chrf_chars', 6, 'length(units)', 'substring(units, i::bigint + 1, n)')},
{_overlap('word_overlap', 'chrf_words', 2, 'len(units)', LIST_GRAM)},
chrf_overlap AS (
  SELECT * FROM char_overlap UNION ALL SELECT id, n + 6, hyp, ref, hits FROM word_overlap),
chrf_orders AS (
  SELECT {by}, n, sum(CASE WHEN ref > 0 THEN hyp ELSE 0 END)::double AS hyp, sum(ref)::double AS ref,
         sum(hits)::double AS hits
  FROM chrf_rows JOIN chrf_overlap USING (id) GROUP BY ALL),
chrf_means AS (
  SELECT {by}, avg(hits / hyp) FILTER (hyp > 0 AND ref > 0) AS p,
         avg(hits / ref) FILTER (hyp > 0 AND ref > 0) AS r
  FROM chrf_orders GROUP BY ALL),
chrf_sizes AS (SELECT {by}, count(*) AS n_samples FROM chrf_rows GROUP BY ALL),
chrf AS (
  SELECT {by}, n_samples, CASE WHEN p + r > 0 THEN 100 * 5 * p * r / (4 * p + r) ELSE 0.0 END AS chrf_pp
  FROM chrf_sizes LEFT JOIN chrf_means USING ({by}))"""


BOTH = "src_lang, tgt_lang"
RESULTS = f"""{SCORED},{bleu(BOTH)},{chrf(BOTH)},
results AS (
  SELECT {DISPLAY} AS direction, n_samples, round(bleu, 2) AS bleu, round(chrf_pp, 2) AS chrf_pp
  FROM bleu JOIN chrf USING (src_lang, tgt_lang, n_samples))"""
METRICS = f"""
metrics AS (
  SELECT {KEY.format('direction')} || '/bleu' AS key, bleu AS value FROM results UNION ALL
  SELECT {KEY.format('direction')} || '/chrf++', chrf_pp FROM results)"""


def _renamed(ctes: str, *names: str) -> str:
    for name in names:
        ctes = ctes.replace(name, f"domain_{name}")
    return ctes


# Each source's own scores are the history.
DOMAIN = "domain, src_lang, tgt_lang"
DOMAIN_SCORES = f"{_renamed(bleu(DOMAIN), 'bleu_')},{_renamed(chrf(DOMAIN), 'chrf_', 'char_', 'word_')}"
DOMAIN_SCORES = DOMAIN_SCORES.replace("\nbleu AS", "\ndomain_bleu AS").replace("\nchrf AS", "\ndomain_chrf AS")
DOMAIN_SCORES = DOMAIN_SCORES.replace("domain_chrf_pp", "chrf_pp")
HISTORY = f"""{DOMAIN_SCORES},
history AS (
  SELECT domain AS run_id, {KEY.format(DISPLAY)} AS direction_key, round(bleu, 2) AS bleu,
         round(chrf_pp, 2) AS chrf_pp
  FROM domain_bleu JOIN domain_chrf USING ({DOMAIN}, n_samples)),
best AS (
  SELECT direction_key, greatest(0.0, max(bleu)) AS best_bleu, greatest(0.0, max(chrf_pp)) AS best_chrf
  FROM history GROUP BY ALL)"""


COMPARISON = f"""SELECT direction, bleu AS current_bleu, chrf_pp AS current_chrf,
  coalesce(best_bleu, 0.0) AS best_prev_bleu, coalesce(best_chrf, 0.0) AS best_prev_chrf,
  round(bleu - coalesce(best_bleu, 0.0), 2) AS bleu_delta,
  round(chrf_pp - coalesce(best_chrf, 0.0), 2) AS chrf_delta,
  'whole' AS current_run_id, 'now' AS current_timestamp,
  (SELECT count(DISTINCT run_id) FROM history) AS previous_runs
FROM results LEFT JOIN best ON direction_key = {KEY.format('direction')}"""
THREE_RUNS = HISTORY.replace(
    "\n  FROM domain_bleu JOIN", "\n  FROM (FROM domain_bleu WHERE domain IN ('src0', 'src1', 'src2')) AS domain_bleu JOIN"
)

# Fingerprints.


def row_hash(*columns: str) -> str:
    return f"sha256(concat_ws('|', {', '.join(encoded(c) for c in sorted(columns))}))"


FOUR = ("src", "tgt", "src_lang", "tgt_lang")


def sampled_hash(size: int, table: str = "pairs", columns: tuple[str, ...] = FOUR) -> str:
    """A hash of the hashes of buckets; copies of a row are their number."""
    return f"""
hashes AS (SELECT {row_hash(*columns)} AS h FROM {table}),
smallest AS (SELECT h, sha256('42|' || h) AS s FROM hashes ORDER BY s LIMIT {size}),
hash_lines AS (SELECT s[1:4] AS bucket, h || ':' || count(*) AS line FROM smallest GROUP BY s, h),
buckets AS (
  SELECT bucket || ':' || sha256(string_agg(line, chr(10) ORDER BY line)) AS b FROM hash_lines GROUP BY bucket),
fingerprint AS (SELECT sha256(string_agg(b, chr(10) ORDER BY b)) AS dataset_hash FROM buckets)"""


# Splits.


def split_by(partition: str, train: float, val: float) -> str:
    over = f"PARTITION BY {partition} " if partition else ""
    return f"""
ranked AS (
  SELECT *, row_number() OVER ({over}ORDER BY {place('doc_id', 'pos')}) - 1 AS rank,
         count(*) OVER ({over}) AS rows FROM pairs),
split AS (
  SELECT *, CASE WHEN rank < floor({train}::double * rows) THEN 'train'
                 WHEN rank < floor({train + val!r}::double * rows) THEN 'val' ELSE 'test' END AS split
  FROM ranked)"""


def grouped_by(keys: list[str], train: float, val: float, of: str = "pairs") -> str:
    names = ", ".join(keys)
    return f"""
sizes AS (SELECT {names}, count(*) AS n, {place(*keys)} AS h FROM {of} GROUP BY {names}),
placed AS (SELECT {names}, sum(n) OVER (ORDER BY h) - n AS before, sum(n) OVER () AS rows FROM sizes),
split AS (
  SELECT {of}.*, CASE WHEN before < floor({train}::double * rows) THEN 'train'
                      WHEN before < floor({train + val!r}::double * rows) THEN 'val' ELSE 'test' END AS split
  FROM {of} JOIN placed USING ({names}))"""


def apportioned_by(stratum: str, train: float, val: float) -> str:
    return f"""
sizes AS (
  SELECT {stratum} AS s, count(*) AS n, {place(stratum)} AS h FROM pairs GROUP BY {stratum}),
ends AS (
  SELECT s, sum(n) OVER (ORDER BY h) AS e, sum(n) OVER (ORDER BY h) - n AS b, sum(n) OVER () AS rows,
         floor({train}::double * sum(n) OVER ())::hugeint AS t, floor({train + val!r}::double * sum(n) OVER ())::hugeint AS tv FROM sizes),
due AS (
  SELECT s, e * t // rows AS te, b * t // rows AS tb, (e - e * t // rows) * (tv - t) // (rows - t) AS ve,
         (b - b * t // rows) * (tv - t) // (rows - t) AS vb FROM ends),
ranked AS (
  SELECT *, {stratum} AS s, row_number() OVER (PARTITION BY {stratum} ORDER BY {place('doc_id', 'pos')}) AS rank FROM pairs),
split AS (
  SELECT ranked.*, CASE WHEN rank <= te - tb THEN 'train' WHEN rank <= te - tb + ve - vb THEN 'val' ELSE 'test' END AS split
  FROM ranked JOIN due USING (s))"""


CHAT = """
chat AS (
  SELECT a.conv_id, a.turn, a.text AS src, b.text AS tgt
  FROM conversations a JOIN conversations b
    ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 AND a.role = 'user' AND b.role = 'assistant')"""

TRIPLETS = f"""{LINES},
triplets AS (
  SELECT a.doc_id, a.pos, {strip('a.line')} AS eng_Latn, {strip('b.line')} AS npi_Deva,
         {strip('c.line')} AS mai_Deva
  FROM lines a JOIN lines b ON b.doc_id = a.doc_id + 1 AND b.pos = a.pos
    JOIN lines c ON c.doc_id = a.doc_id + 2 AND c.pos = a.pos
  WHERE {strip('a.line')} <> '' AND {strip('b.line')} <> '' AND {strip('c.line')} <> '')"""

TEXT_FILES = f"""{LINES},
files AS (
  SELECT a.source AS domain, unnest(['eng_Latn', 'npi_Deva', 'mai_Deva']) AS code,
         unnest([a.line, b.line, c.line]) AS line, a.doc_id, a.pos
  FROM lines a JOIN lines b ON b.doc_id = a.doc_id + 1 AND b.pos = a.pos
    JOIN lines c ON c.doc_id = a.doc_id + 2 AND c.pos = a.pos),
file_lines AS (
  SELECT domain, code, {strip('line')} AS line,
         row_number() OVER (PARTITION BY domain, code ORDER BY doc_id, pos) AS place
  FROM files WHERE NOT (domain = 'src1' AND code = 'mai_Deva')),
placed AS (
  SELECT *, place - min(place) FILTER (line <> '') OVER (PARTITION BY domain, code) AS line_no
  FROM file_lines),
aligned AS (
  SELECT domain, line_no, e.line AS eng_Latn, n.line AS npi_Deva, m.line AS mai_Deva
  FROM placed e JOIN placed n USING (domain, line_no) JOIN placed m USING (domain, line_no)
  WHERE e.code = 'eng_Latn' AND n.code = 'npi_Deva' AND m.code = 'mai_Deva' AND line_no >= 0
    AND e.line <> '' AND n.line <> '' AND m.line <> '')"""
FOUR_WAYS = (
    ("eng_Latn", "npi_Deva"), ("npi_Deva", "eng_Latn"), ("eng_Latn", "mai_Deva"), ("mai_Deva", "eng_Latn"),
)


def fanned_out(table: str, keys: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, {a} AS src, {b} AS tgt, '{a}' AS src_lang, '{b}' AS tgt_lang, "
        f"{i}::bigint AS direction_no FROM {table}"
        for i, (a, b) in enumerate(FOUR_WAYS)
    )


# Tokens.

TAGGED = "src_lang || ' ' || tgt_lang || ' ' || src"


def vocabulary(*texts: str, table: str = "pairs") -> str:
    parts = " UNION ALL ".join(f"SELECT unnest({words(t)}) AS token FROM {table}" for t in texts)
    return f"""
occurrences AS ({parts}),
vocab AS (
  SELECT token, count(*) AS n, row_number() OVER (ORDER BY sha256(token)) + 2 AS token_id
  FROM occurrences GROUP BY token)"""


def ids(name: str, text: str, room: int | str = "", table: str = "pairs") -> str:
    return f"""
{name} AS (
  SELECT doc_id, pos, list_append(coalesce(list(coalesce(token_id, 1) ORDER BY i)
      FILTER (token IS NOT NULL), []), 2) AS ids
  FROM (SELECT doc_id, pos, unnest(CASE WHEN len(w) = 0 THEN [NULL] ELSE w END) AS token,
               unnest(CASE WHEN len(w) = 0 THEN [0] ELSE range(len(w)) END) AS i
        FROM (SELECT doc_id, pos, {words(text)}[1:{room}] AS w FROM {table}))
  LEFT JOIN vocab USING (token) GROUP BY doc_id, pos)"""


TOKEN_ROWS = """
token_rows AS (
  SELECT doc_id, pos, i.ids AS input_ids, t.ids AS labels FROM inputs i JOIN targets t USING (doc_id, pos))"""
TOKENS = f"{PAIRS},{vocabulary(TAGGED)},{ids('inputs', TAGGED)},{ids('targets', 'tgt')},{TOKEN_ROWS}"
CUT_TOKENS = f"{PAIRS},{vocabulary(TAGGED)},{ids('inputs', TAGGED, 63)},{ids('targets', 'tgt', 63)},{TOKEN_ROWS}"


def repeated(value: str, times: str) -> str:
    return f"list_transform(range({times}), lambda x: {value})"


def spaced(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


SHOWN_TOKENS = (
    f"{spaced('input_ids')} AS input_ids, {spaced(repeated('1', 'len(input_ids)'))} AS attention_mask, "
    f"{spaced('labels')} AS labels"
)

# From pairs to a recorded run.

PREPARED = f"""{COUNTED},
valid AS ({first_of("(SELECT * FROM tagged WHERE reason IS NULL)", "src", "doc_id, pos", "*")}),
normal AS (
  SELECT doc_id, pos, {normalize('src')} AS src, {normalize('tgt')} AS tgt, src_lang, tgt_lang, domain FROM valid),
places AS (
  SELECT *, row_number() OVER (ORDER BY {place('doc_id', 'pos')}) - 1 AS rank, count(*) OVER () AS rows
  FROM normal),
prepared AS (
  SELECT *, CASE WHEN rank < floor(0.9::double * rows) THEN 'train'
                 WHEN rank < floor({0.9 + 0.05!r}::double * rows) THEN 'val' ELSE 'test' END AS split
  FROM places)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


ORACLES = {
    "rejection_reasons": _with(
        COUNTED, "SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM tagged GROUP BY ALL"
    ),
    "rejections_by_direction": _with(
        COUNTED,
        "SELECT src_lang, tgt_lang, count(*) AS total_input, "
        + ", ".join(f"count(*) FILTER (reason = '{r}') AS {r}" for r in RULES)
        + ", count(*) FILTER (reason IS NULL) AS kept FROM tagged GROUP BY src_lang, tgt_lang",
    ),
    "rule_outcomes": _with(
        COUNTED,
        "SELECT doc_id, pos, "
        + ", ".join(f"f{i}::int AS {r}" for i, r in enumerate(RULES, 1)) + " FROM flagged",
    ),
    "validation_report": _with(COUNTED, REPORT),
    "rejections_per_rule": _with(
        COUNTED,
        "SELECT rule, count(reason) AS rejected FROM (VALUES "
        + ", ".join(f"('{r}')" for r in RULES)
        + ") AS r(rule) LEFT JOIN tagged ON reason = rule GROUP BY rule",
    ),
    "valid_pairs": _with(
        COUNTED,
        first_of(
            "(SELECT * FROM tagged WHERE reason IS NULL)", "src", "doc_id, pos",
            "doc_id, pos, src, tgt, src_lang, tgt_lang, domain",
        ),
    ),
    "user_rule_rejections": _with(
        COUNTED
        + f""",
more AS (
  SELECT CASE WHEN reason IS NOT NULL THEN reason WHEN contains(src, '|') THEN 'no_pipe'
    WHEN list_max(list_transform({words('tgt')}, lambda w: length(w))) > 14 THEN 'short_words' END AS reason
  FROM tagged)""",
        "SELECT rule, count(reason) AS rejected FROM (VALUES "
        + ", ".join(f"('{r}')" for r in (*RULES, "no_pipe", "short_words"))
        + ") AS r(rule) LEFT JOIN more ON reason = rule GROUP BY rule",
    ),
    "keep_first_by_source_text": _with(
        PAIRS, first_of("pairs", "src", "doc_id, pos", "doc_id, pos, src, tgt_lang")
    ),
    "keep_first_by_pair": _with(
        PAIRS, first_of("pairs", "src, tgt", "doc_id, pos", "doc_id, pos, src, tgt")
    ),
    "text_measures": f"""
SELECT doc_id, len({words('text')}) AS words, length({strip('text')}) AS stripped,
  length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS letters,
  length(replace(text, ' ', '')) AS no_spaces, regexp_matches(text, '{LETTER}')::int AS content,
  sha256(text) AS sha256 FROM documents""",
    "normalized_documents": "SELECT doc_id, "
    + normalize("replace(replace(text, chr(233), 'e' || chr(769)), ', ', ', ' || chr(8203) || chr(9))")
    + " AS text FROM documents",
    "normalized_pairs": _with(
        PAIRS, f"SELECT doc_id, pos, {normalize('src')} AS src, {normalize('tgt')} AS tgt FROM pairs"
    ),
    "tagged_inputs": _with(PAIRS, f"SELECT doc_id, pos, {TAGGED} AS input FROM pairs"),
    "repaired_question_marks":
        "SELECT conv_id, turn, replace(text, '.', '?') AS text FROM conversations",
    "mapped_conversations": _with(
        CHAT,
        "SELECT conv_id, turn, src, tgt, 'user' AS src_lang, 'assistant' AS tgt_lang, "
        "'general' AS domain FROM chat",
    ),
    "line_triplets": _with(TRIPLETS, 'SELECT doc_id, pos, eng_Latn, npi_Deva, mai_Deva FROM triplets'),
    "fanned_out_triplets": _with(TRIPLETS, fanned_out("triplets", "doc_id, pos")),
    "aligned_text_files": _with(TEXT_FILES, fanned_out("aligned", "domain, line_no")),
    "domains_without_all_files": "SELECT DISTINCT source AS domain, 'maithili' AS missing "
    "FROM documents WHERE source = 'src1'",
    "ingestion_summary": _with(
        PAIRS,
        "SELECT count(*) AS n_rows, count(DISTINCT src_lang) AS src_langs, "
        "greatest(count(DISTINCT domain), 1) AS domains FROM pairs",
    ),
    "direction_groups": _with(
        PAIRS,
        f"SELECT src_lang || ' -> ' || tgt_lang AS raw, {DISPLAY} AS direction, "
        f"{KEY.format(DISPLAY)} || '/bleu' AS bleu_key, count(*) AS n_rows FROM pairs "
        "GROUP BY src_lang, tgt_lang",
    ),
    "sampled_pairs": _with(
        PAIRS, f"SELECT doc_id, pos, src, tgt FROM pairs ORDER BY {place('doc_id', 'pos')} LIMIT 1000"
    ),
    "sampled_then_first": _with(
        PAIRS
        + f""",
sample AS (SELECT *, {place('doc_id', 'pos')} AS place FROM pairs ORDER BY place LIMIT 1000)""",
        first_of("sample", "src", "place", "doc_id, pos, src, place"),
    ),
    "split_pairs": _with(PAIRS + "," + split_by("", 0.9, 0.05), "SELECT doc_id, pos, split FROM split"),
    "split_statistics": _with(
        PAIRS + "," + split_by("", 0.9, 0.05),
        "SELECT count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, "
        "count(*) FILTER (split = 'test') AS test, "
        "array_to_string(list_sort(list(DISTINCT src_lang || ' -> ' || tgt_lang)), ',') AS directions, "
        "array_to_string(list_sort(list(DISTINCT domain)), ',') AS domains FROM split",
    ),
    "stratified_pairs": _with(
        PAIRS + "," + split_by(BOTH, 0.8, 0.1), "SELECT doc_id, pos, split FROM split"
    ),
    "grouped_split_pairs": _with(
        PAIRS + "," + grouped_by(["doc_id"], 0.9, 0.05), "SELECT doc_id, pos, split FROM split"
    ),
    "grouped_split_directions": _with(
        PAIRS + ", both_ways AS (SELECT doc_id, pos, way FROM pairs, (VALUES ('there'), ('back')) AS w(way)),"
        + grouped_by(["doc_id", "pos"], 0.8, 0.1, "both_ways"),
        "SELECT doc_id, pos, way, split FROM split",
    ),
    "proportional_strata_split": _with(
        PAIRS + "," + apportioned_by("doc_id // 10", 0.8, 0.1), "SELECT doc_id, pos, split FROM split"
    ),
    "ranked_pairs": _with(
        PAIRS,
        f"SELECT doc_id, pos, row_number() OVER (ORDER BY {place('doc_id', 'pos')}) - 1 AS rank FROM pairs",
    ),
    "locked_test": _with(
        PAIRS + "," + split_by("", 0.9, 0.05),
        "SELECT doc_id, pos, src, tgt FROM split WHERE split = 'test'",
    ),
    "locked_test_csv": _with(
        PAIRS + "," + split_by("", 0.9, 0.05),
        "SELECT doc_id, pos, src, tgt, domain FROM split WHERE split = 'test'",
    ),
    "leaked_source_texts": _with(
        PAIRS + "," + split_by("", 0.9, 0.05),
        "SELECT doc_id, pos, split FROM split WHERE split <> 'test' "
        "AND src IN (SELECT src FROM split WHERE split = 'test')",
    ),
    "leak_report": _with(
        PAIRS + "," + split_by("", 0.9, 0.05) + ", locked AS (SELECT * FROM split WHERE split = 'test')",
        "SELECT split, count(*) AS n_rows, "
        "count(*) FILTER ((src, tgt) IN (SELECT (src, tgt) FROM locked)) AS leaked_pairs, "
        "count(*) FILTER (src IN (SELECT src FROM locked)) AS leaked_sources, "
        "count(*) FILTER (tgt IN (SELECT tgt FROM locked)) AS leaked_targets "
        "FROM split WHERE split <> 'test' GROUP BY split",
    ),
    "csv_conversations": _with(
        CHAT,
        "SELECT conv_id, turn, src, tgt, 'NA' AS src_lang, 'null' AS tgt_lang, 'general' AS domain FROM chat",
    ),
    "split_csv_conversations": _with(
        CHAT,
        "SELECT conv_id, turn, src, tgt, 'NA' AS src_lang, 'null' AS tgt_lang, 'general' AS domain FROM chat",
    ),
    "table_formats": _with(
        PAIRS,
        "SELECT src_lang, tgt_lang, count(*) AS n, sum(length(src) + length(tgt))::bigint AS chars, "
        "format FROM pairs, (VALUES ('parquet'), ('orc'), ('json')) AS f(format) "
        "GROUP BY src_lang, tgt_lang, format",
    ),
    "stored_report": _with(COUNTED, REPORT),
    "bleu_by_direction": _with(
        f"{SCORED},{bleu(BOTH)}", f"SELECT {BOTH}, n_samples, round(bleu, 2) AS bleu FROM bleu"
    ),
    "chrf_by_direction": _with(
        f"{SCORED},{chrf(BOTH)}", f"SELECT {BOTH}, n_samples, round(chrf_pp, 2) AS chrf_pp FROM chrf"
    ),
    "evaluation_table": _with(RESULTS, "SELECT *, NULL::varchar AS domain FROM results"),
    "evaluation_by_domain": _with(
        f"{RESULTS},{DOMAIN_SCORES}",
        f"SELECT *, NULL::varchar AS domain, true AS is_total FROM results UNION ALL "
        f"SELECT {DISPLAY}, n_samples, round(bleu, 2), round(chrf_pp, 2), domain, false "
        f"FROM domain_bleu JOIN domain_chrf USING ({DOMAIN}, n_samples)",
    ),
    "whole_corpus_metrics": _with(
        f"""{SCORED},
stripped AS (SELECT 1 AS one, {strip('prediction')} AS prediction, {strip('tgt')} AS tgt FROM scored),
{bleu('one', 'stripped')},{chrf('one', 'stripped')}""",
        'SELECT round(bleu, 2) AS bleu, round(chrf_pp, 2) AS "chrf++" FROM bleu JOIN chrf USING (one)',
    ),
    "dataset_fingerprint": _with(
        PAIRS + "," + sampled_hash(1000), "SELECT dataset_hash FROM fingerprint"
    ),
    "dataset_fingerprint_small": _with(
        CHAT + "," + sampled_hash(10_000_000, "chat", ("conv_id", "turn", "src", "tgt")),
        "SELECT dataset_hash FROM fingerprint",
    ),
    "whole_dataset_fingerprint": _with(
        PAIRS
        + f""",
hashes AS (
  SELECT {row_hash('doc_id', 'pos', 'src', 'tgt', 'src_lang', 'tgt_lang', 'domain')} AS h FROM pairs)""",
        "SELECT sha256(concat_ws('|', count(*)::varchar, "
        + ", ".join(
            f"sum(('0x' || substring(h, {1 + 8 * i}, 8))::bigint)::varchar" for i in range(8)
        )
        + ")) AS dataset_hash, count(*) AS n_rows FROM hashes",
    ),
    "run_with_results": _with(
        PAIRS + "," + sampled_hash(5000),
        "SELECT '0123456789abcdef' AS run_id, sha256('{\"seed\": 42}') AS config_hash, dataset_hash, "
        "12.5::double AS training_duration_seconds, (SELECT 2 * count(DISTINCT (src_lang, tgt_lang)) "
        "FROM pairs) AS n_metrics, 'spark' AS engine FROM fingerprint",
    ),
    "final_metric_map": _with(f"{RESULTS},{METRICS}", "SELECT key, value FROM metrics"),
    "best_earlier_scores": _with(
        f"{SCORED},{HISTORY}",
        "SELECT direction_key, 'bleu' AS metric, best_bleu AS best FROM best UNION ALL "
        "SELECT direction_key, 'chrf', best_chrf FROM best",
    ),
    "run_comparison": _with(f"{RESULTS},{HISTORY}", COMPARISON),
    "run_history_comparison": _with(f"{RESULTS},{THREE_RUNS}", COMPARISON),
    "recorded_run": _with(
        f"""{PREPARED},
turned AS (
  SELECT *, array_to_string(list_reverse({words('src')}), ' ') || chr(1567) AS prediction
  FROM prepared WHERE split = 'test'),
{bleu(BOTH, 'turned')},{chrf(BOTH, 'turned')}""",
        f"""SELECT {DISPLAY} AS direction, round(bleu, 2) AS current_bleu, round(chrf_pp, 2) AS current_chrf,
  round(bleu, 2) AS best_prev_bleu, round(chrf_pp, 2) AS best_prev_chrf, 0.0::double AS bleu_delta,
  0.0::double AS chrf_delta, '01234567-second' AS current_run_id,
  '2026-01-01T00:00:00+00:00' AS current_timestamp, 1::bigint AS previous_runs
FROM bleu JOIN chrf USING (src_lang, tgt_lang, n_samples)""",
    ),
    "prepared_pairs": _with(PREPARED, "SELECT doc_id, pos, src, tgt, split FROM prepared"),
    "prepared_tokens": _with(
        f"""{PREPARED},
train AS (SELECT * FROM prepared WHERE split = 'train'),
learned AS (SELECT * FROM prepared WHERE split <> 'test'),
{vocabulary(TAGGED, table='train')},{ids('inputs', TAGGED, table='learned')},{ids('targets', 'tgt', table='learned')},{TOKEN_ROWS}""",
        f"SELECT doc_id, pos, split, {SHOWN_TOKENS} FROM token_rows JOIN learned USING (doc_id, pos)",
    ),
    "content_rule_rejections": _with(
        COUNTED,
        "SELECT src_lang, count(*) AS total_input, 0::bigint AS min_length, count(*) FILTER (NOT f2) AS max_length, "
        "0::bigint AS length_ratio, count(*) FILTER (f2 AND NOT f5) AS not_empty_or_numeric, "
        "count(*) FILTER (f2 AND f5) AS kept FROM flagged GROUP BY src_lang",
    ),
    "sampled_by_text_keys": _with(
        PAIRS,
        "SELECT doc_id, pos FROM pairs ORDER BY "
        + place(
            "CASE WHEN pos % 3 <> 0 THEN src_lang || '|' || tgt_lang END",
            "doc_id::varchar || '|' || pos::varchar",
        )
        + " LIMIT 700",
    ),
    "many_strata_split": _with(
        PAIRS + "," + split_by("doc_id // 10", 0.8, 0.1), "SELECT doc_id, pos, split FROM split"
    ),
    "tracked_tables": _with(
        RESULTS,
        "SELECT 'evaluation/results_table' AS name, direction, n_samples, bleu, chrf_pp AS \"chrf++\" FROM results",
    ),
    "tracked_checkpoints": _with(
        PAIRS + "," + sampled_hash(5000),
        "SELECT 'checkpoint' AS type, '0123456789abcdef' AS run_id, dataset_hash, step::bigint AS global_step, "
        "step / 1000.0::double AS epoch FROM fingerprint, (VALUES (500), (1000)) AS s(step) UNION ALL "
        "SELECT 'result', NULL, dataset_hash, NULL, NULL FROM fingerprint",
    ),
    "stored_runs": _with(
        f"{RESULTS},{METRICS},{sampled_hash(5000)}",
        "SELECT '0123456789abcdef' AS run_id, dataset_hash, key, value FROM metrics, fingerprint",
    ),
    "stored_results": _with(
        RESULTS,
        "SELECT file, direction, n_samples, bleu, chrf_pp FROM results, (VALUES ('json'), ('csv')) AS f(file)",
    ),
    "tracked_results": _with(
        f"{RESULTS},{METRICS}", "SELECT 'run' AS run_id, 7::bigint AS step, key, value FROM metrics"
    ),
    "vocabulary": _with(
        f"{PAIRS},{vocabulary(TAGGED, 'tgt')}", "SELECT token, n, token_id FROM vocab"
    ),
    "token_ids": _with(
        TOKENS, f"SELECT doc_id, pos, {SHOWN_TOKENS} FROM token_rows"
    ),
    "truncated_token_ids": _with(CUT_TOKENS, f"SELECT doc_id, pos, {SHOWN_TOKENS} FROM token_rows"),
    "padded_token_batches": _with(
        TOKENS
        + f""",
numbered AS (
  SELECT *, (row_number() OVER (ORDER BY {place('doc_id', 'pos')}) - 1) // 16 AS batch_id FROM token_rows),
sized AS (
  SELECT *, (ceil(max(len(input_ids)) OVER (PARTITION BY batch_id) / 8.0) * 8)::bigint AS i,
         (ceil(max(len(labels)) OVER (PARTITION BY batch_id) / 8.0) * 8)::bigint AS l FROM numbered),
padded AS (
  SELECT doc_id, pos, batch_id,
    list_concat(input_ids, {repeated('0', 'i - len(input_ids)')}) AS input_ids,
    list_concat({repeated('1', 'len(input_ids)')}, {repeated('0', 'i - len(input_ids)')}) AS mask,
    list_concat(labels, {repeated('-100', 'l - len(labels)')}) AS labels FROM sized)""",
        f"SELECT doc_id, pos, batch_id, {spaced('input_ids')} AS input_ids, "
        f"{spaced('mask')} AS attention_mask, {spaced('labels')} AS labels, "
        + spaced(
            "list_concat([2], list_transform(labels[1:len(labels) - 1], "
            "lambda x: CASE WHEN x = -100 THEN 0 ELSE x END))"
        )
        + " AS decoder_input_ids FROM padded",
    ),
    "user_tokenizer_ids": _with(
        f"""{PAIRS},
counted AS (
  SELECT doc_id, pos, list_transform({words(TAGGED)}, lambda w: length(w)) AS i,
         list_transform({words('tgt')}, lambda w: length(w)) AS l FROM pairs)""",
        f"SELECT doc_id, pos, {spaced('i')} AS input_ids, {spaced(repeated('1', 'len(i)'))} "
        f"AS attention_mask, {spaced('l')} AS labels FROM counted",
    ),
    "translations": _with(
        PAIRS,
        f"SELECT doc_id, pos, array_to_string(list_reverse({words('src')}), ' ') || '?' AS prediction FROM pairs",
    ),
    "scored_translations": _with(
        f"""{PAIRS},
turned AS (
  SELECT *, array_to_string(list_reverse({words('src')}), ' ') || '?' AS prediction FROM pairs),
{bleu(BOTH, 'turned')},{chrf(BOTH, 'turned')}""",
        f"SELECT {DISPLAY} AS direction, n_samples, round(bleu, 2) AS bleu, round(chrf_pp, 2) AS chrf_pp, "
        "NULL::varchar AS domain FROM bleu JOIN chrf USING (src_lang, tgt_lang, n_samples)",
    ),
}
