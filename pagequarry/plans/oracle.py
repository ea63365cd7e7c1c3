"""SQL fragments of the oracle: the derived inputs and column rules, in DuckDB's dialect."""

from __future__ import annotations

from pagequarry.functions.text import HTML_RULES, WHITESPACE
from pagequarry.plans.inputs import NAME_PARTS, PAGE_CHARS, RUN_TIME, SHEETS, SUFFIXES


def text_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def strip(expr: str) -> str:
    return f"trim({expr}, '{WHITESPACE}')"


STEM = r"regexp_replace(filename, '(?s)^(.+)\.[^.]+$', '\1')"


def safe(expr: str) -> str:
    return rf"regexp_replace({expr}, '[^\p{{L}}\p{{N}}._-]', '', 'g')"


DOC_ID = f"substring({safe(STEM)}, 1, 100)"
TYPE = r"""CASE lower(regexp_extract(filename, '(?s)^.+(\.[^.]+)$', 1))
  WHEN '.pdf' THEN 'pdf' WHEN '.xlsx' THEN 'excel' WHEN '.csv' THEN 'csv' END"""
CATEGORY = """CASE WHEN contains(lower(filename), 'transcript') THEN 'transcript'
  WHEN contains(lower(filename), 'bank') OR contains(lower(filename), 'statement') THEN 'financial'
  WHEN contains(lower(filename), 'report') OR contains(lower(filename), 'exhibit') OR contains(lower(filename), 'affidavit') THEN 'legal'
  ELSE 'other' END"""

FILES = f"""files AS (
  SELECT '/corpus/' || lang || '/' || filename AS path, filename, length, content, source_id FROM (
    SELECT doc_id AS source_id, lang, n_chars AS length, text AS content,
      source || '_' || ({text_list(NAME_PARTS)})[doc_id % {len(NAME_PARTS)} + 1] || ' (' || (doc_id % 7) || ') '
        || doc_id || ({text_list(SUFFIXES)})[doc_id % {len(SUFFIXES)} + 1] AS filename
    FROM documents))"""

# The documents as files of a folder, and what a run over them gives.
CORPUS = f"""corpus AS (
  SELECT *, lang || '/' || filename AS file, CASE doc_id % 4
      WHEN 1 THEN '{{"Data": [["id", "chars"], [' || doc_id || ', ' || coalesce(n_chars, 0) || ']], "Notes": [["note"]]}}'
      WHEN 2 THEN 'id,"source, lang"' || chr(10) || doc_id || ',"' || source || ', ' || lang || '"' || chr(10)
      ELSE text || CASE WHEN doc_id % 8 = 0 THEN chr(10) || '| id | source |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || doc_id || ' | ' || source || ' |' || chr(10)
        ELSE '' END END AS content FROM (
    SELECT doc_id, n_chars, coalesce(text, '') AS text, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
      CASE doc_id % 11 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE '' END || coalesce(source, 'none') || '_' || ({text_list(NAME_PARTS)})[doc_id % {len(NAME_PARTS)} + 1]
        || ' (' || (doc_id % 7) || ') ' || doc_id || ({text_list(SUFFIXES)})[doc_id % {len(SUFFIXES)} + 1] AS filename
    FROM documents)),
  corpus_run AS (
    SELECT file, filename, {DOC_ID} AS doc_id, {TYPE} AS type, {CATEGORY} AS category, strlen(content) AS length, sha256(content) AS hash,
      CAST(CASE doc_id % 4 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE len(string_split(content, chr(12))) END AS INTEGER) AS pages,
      CAST(CASE doc_id % 4 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE CAST(doc_id % 8 = 0 AS INTEGER) END AS INTEGER) AS csv_files, doc_id AS source_id
    FROM corpus WHERE doc_id % 4 <> 3)"""

ALL = FILES + f""", allfiles AS (
  SELECT source_id, path, filename, length, {DOC_ID} AS doc_id, {TYPE} AS type, {CATEGORY} AS category,
    sha256(content) AS hash FROM files)"""

REG = ALL + """, reg AS (
  SELECT *, 'logs/' || doc_id || '.log' AS log FROM allfiles
  WHERE path LIKE '%.pdf' OR path LIKE '%.xlsx' OR path LIKE '%.csv')"""

INDEX = REG + """, idx AS (
  SELECT reg.doc_id, path, filename, type, category, log,
    CASE WHEN quality = 0 THEN sha256(hash || '-old') ELSE hash END AS hash,
    CASE WHEN toxic = 1 THEN 'failed' ELSE 'completed' END AS status
  FROM reg JOIN labels ON labels.doc_id = source_id)"""

RECORDS = INDEX + f""", recs AS (
  SELECT *, CASE WHEN status = 'failed' THEN []::VARCHAR[] ELSE list_transform(names, lambda n: 'md/' || category || '/' || n || '.md') END AS output_md,
    CASE WHEN status = 'failed' OR type = 'pdf' THEN []::VARCHAR[] ELSE list_transform(names, lambda n: 'csv/' || category || '/' || n || '.csv') END AS output_csv
  FROM (
    SELECT reg.*, CASE WHEN toxic = 1 THEN 'failed' ELSE 'completed' END AS status,
      CAST(CASE WHEN type = 'csv' THEN 1 WHEN toxic = 1 THEN 0 WHEN type = 'pdf' THEN ceil(length / {PAGE_CHARS}.0) ELSE {len(SHEETS)} END AS INTEGER) AS pages,
      CASE WHEN type = 'pdf' THEN list_transform(range(1, CAST(ceil(length / {PAGE_CHARS}.0) AS BIGINT) + 1), lambda p: reg.doc_id || '_p' || p)
        WHEN type = 'excel' THEN list_transform({text_list(SHEETS)}, lambda s: reg.doc_id || '_' || s) ELSE [reg.doc_id] END AS names
    FROM reg LEFT JOIN labels ON labels.doc_id = source_id))"""

EMBEDDED = RECORDS + """, emb AS (
  SELECT recs.*, CASE WHEN status = 'completed' AND len(output_md) > 0 THEN
      CASE WHEN n > 0 THEN 'completed' ELSE 'failed' END END AS embed_status
  FROM recs LEFT JOIN (SELECT vec_id, count(*) AS n FROM embeddings GROUP BY vec_id) v ON v.vec_id = source_id)"""

RESULTS = EMBEDDED + """, results AS (
  SELECT emb.* REPLACE (CASE WHEN i.doc_id IS NOT NULL THEN 'skipped' ELSE emb.status END AS status)
  FROM emb LEFT JOIN idx i ON i.doc_id = emb.doc_id AND i.hash = emb.hash)"""

PAGED = """paged AS (
  SELECT CAST(conv_id AS VARCHAR) AS doc_id, CAST(turn + 1 AS INTEGER) AS page, coalesce(text, '') AS text,
    CAST(length(coalesce(text, '')) AS INTEGER) AS text_length FROM conversations)"""

ENRICHED = ALL + ", " + PAGED + """, enriched AS (
  SELECT paged.doc_id, page, text, text_length, a.doc_id AS name_id, filename, category, hash
  FROM paged JOIN allfiles a ON CAST(a.source_id AS VARCHAR) = paged.doc_id)"""

RENDERED = ENRICHED + f""", rendered AS (
  SELECT name_id AS doc_id, page, category, hash, name_id || '_p' || page AS chunk_id,
    'md/' || category || '/' || name_id || '_p' || page || '.md' AS md_file, text_length,
    '<!--' || chr(10) || 'chunk_id: ' || name_id || '_p' || page || chr(10) || 'source: ' || filename || chr(10)
    || 'page: ' || page || chr(10) || 'category: ' || category || chr(10) || 'hash: ' || hash || chr(10) || '-->'
    || chr(10) || chr(10) || '# ' || filename || ' - Page ' || page || chr(10) || chr(10) || '## Content' || chr(10) || text
    || chr(10) || chr(10) || '## Processing Information' || chr(10) || '- Document ID: ' || name_id || chr(10)
    || '- Extracted using: conversation turns' || chr(10) || '- Text length: ' || length(text) || ' characters' || chr(10)
    || '- Processing timestamp: {RUN_TIME}' || chr(10) AS md
  FROM enriched)"""


def without_comments(source: str, out: str) -> str:
    """CTEs: source(kind, id, md) to out(kind, id, text), line by line."""
    line = strip("line")
    return f"""lines AS (
  SELECT kind, id, unnest(string_split(md, chr(10))) AS line,
    generate_subscripts(string_split(md, chr(10)), 1) AS ln FROM {source}),
marked AS (
  SELECT *, CASE WHEN {line} LIKE '<!--%' THEN true WHEN {line} LIKE '%-->' THEN false END AS ev FROM lines),
stated AS (
  SELECT *, last_value(ev IGNORE NULLS) OVER (PARTITION BY kind, id ORDER BY ln ROWS UNBOUNDED PRECEDING) AS opened FROM marked),
{out} AS (
  SELECT kind, id, coalesce(string_agg(line, chr(10) ORDER BY ln) FILTER (WHERE ev IS NULL AND NOT coalesce(opened, false)), '') AS text
  FROM stated GROUP BY kind, id)"""


def html_text(expr: str) -> str:
    for pattern, replacement in HTML_RULES:
        p, r = pattern.replace("'", "''"), replacement.replace("'", "''")
        expr = f"regexp_replace({expr}, '{p}', '{r}', 'g')"
    return strip(expr)


def squared(a: str, b: str) -> str:
    return f"power(list_distance(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[])), 2)"


def cosine(a: str, b: str) -> str:
    return f"list_cosine_similarity(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"


CENTROIDS = """items AS (
  SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
centroids AS (
  SELECT label, list(m ORDER BY pos) AS embedding FROM (
    SELECT label, pos, avg(CAST(x AS DOUBLE)) AS m FROM items GROUP BY label, pos) GROUP BY label),
middle AS (
  SELECT list(m ORDER BY pos) AS embedding FROM (SELECT pos, avg(CAST(x AS DOUBLE)) AS m FROM items GROUP BY pos))"""

NUMBERED = """numbered AS (
  SELECT CAST(o_custkey AS VARCHAR) AS doc_id, o_orderkey AS table_id, o_orderstatus,
    CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS table_idx FROM orders)"""

SIZE, OVERLAP = 1000, 200


def recursive_chunks(source: str) -> str:
    """CTEs: source(id, txt) to chunks(id, chunk_index, chunk).

    Level by level: texts that hold the level's separator are cut, pieces below the size are leaves
    and longer ones go down. Neighbouring leaves of one parent form a run; a recursive query then
    walks each run from window to window.
    """
    parts = [f"long0 AS (SELECT id, [0] AS path, txt FROM {source} WHERE {strip('txt')} <> '')"]
    for level, sep in enumerate(("chr(10) || chr(10)", "chr(10)", "'. '", "' '")):
        parts.append(f"""
pieces{level} AS (
  SELECT *, count(*) FILTER (WHERE length(piece) >= {SIZE}) OVER (PARTITION BY id, path ORDER BY i) AS longs FROM (
    SELECT id, path, i, CASE WHEN i = 1 THEN p ELSE {sep} || p END AS piece FROM (
      SELECT id, path, unnest(string_split(txt, {sep})) AS p, generate_subscripts(string_split(txt, {sep}), 1) AS i
      FROM long{level} WHERE contains(txt, {sep}))) WHERE piece <> ''),
long{level + 1} AS (
  SELECT id, list_append(path, i) AS path, piece AS txt FROM pieces{level} WHERE length(piece) >= {SIZE}
  UNION ALL SELECT id, path, txt FROM long{level} WHERE NOT contains(txt, {sep}))""")
    leaves = " UNION ALL ".join(
        f"SELECT id, list_append(path, min(i)) AS path, string_agg(piece, '' ORDER BY i) AS txt, list(length(piece) ORDER BY i) AS lens "
        f"FROM pieces{n} WHERE length(piece) < {SIZE} GROUP BY id, path, longs" for n in range(4))
    stride = SIZE - OVERLAP
    return ", ".join(parts) + f""", runs AS (
  SELECT id, path, txt, list_transform(range(0, len(lens) + 1), lambda n: coalesce(list_sum(lens[1:n]), 0)::BIGINT) AS c FROM ({leaves})),
walk AS (
  SELECT id, path, txt, c, 1 AS first, len(list_filter(c, lambda v: v <= {SIZE})) AS stop FROM runs
  UNION ALL
  SELECT id, path, txt, c, nf AS first, len(list_filter(c, lambda v: v - c[nf] <= {SIZE})) AS stop FROM (
    SELECT *, list_filter(range(first, stop + 1), lambda j: j = stop OR (c[stop] - c[j] <= {OVERLAP} AND c[stop + 1] - c[j] <= {SIZE}))[1] AS nf
    FROM walk WHERE stop < len(c))),
spans AS (
  SELECT id, path, c[first] AS a, substring(txt, c[first] + 1, c[stop] - c[first]) AS raw FROM walk
  UNION ALL
  SELECT id, path, a, substring(txt, a + 1, {SIZE}) FROM (
    SELECT id, path, txt, unnest(list_transform(range(0, greatest(CAST(ceil((length(txt) - {OVERLAP}) / {stride}.0) AS BIGINT), 1)), lambda k: k * {stride})) AS a FROM long4)),
chunks AS (
  SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY path, a) - 1 AS INTEGER) AS chunk_index, chunk
  FROM (SELECT *, {strip('raw')} AS chunk FROM spans) WHERE chunk <> '')"""


def tfidf(source: str, dimensions: int, word_break: str, fitted_on: str | None = None) -> str:
    """CTEs: source(chunk_id, chunk) to weights(chunk_id, bucket, w): hashed tf-idf of unit length,
    with the document frequencies of ``fitted_on``, by default the source itself.

    The bucket is the public 32-bit MurmurHash3 of the word's bytes with seed 42.
    """
    m = 4294967296
    fitted = fitted_on or source

    def times(a: str, b: int) -> str:
        return f"(({a}) * {b}::UBIGINT) % {m}"

    def mixed(k: str) -> str:
        first = times(k, 0xCC9E2D51)
        turned = f"(({first}) * 32768) % {m} + ({first}) // 131072"
        return times(turned, 0x1B873593)

    def block(at: str, n: int) -> str:
        return " + ".join(f"bytes[{at} + {i}]::UBIGINT * {256 ** i}::UBIGINT" for i in range(n))

    step = f"list_reduce(list_prepend(42::UBIGINT, blocks), lambda h, k: ((((xor(h, k) * 8192) % {m} + xor(h, k) // 524288) * 5) % {m} + {0xE6546B64}) % {m})"
    last = "CASE n % 4 " + " ".join(f"WHEN {r} THEN {mixed(block('n // 4 * 4 + 1', r))}" for r in (1, 2, 3)) + " ELSE 0::UBIGINT END"
    f1 = times("xor(a, a // 65536)", 0x85EBCA6B)
    f2 = times("xor(b, b // 8192)", 0xC2B2AE35)
    return f"""words AS (
  SELECT chunk_id, word FROM (SELECT chunk_id, unnest(regexp_split_to_array(lower(chunk), '{word_break}')) AS word FROM {source}) WHERE word <> ''),
vocabulary AS (
  SELECT word, n, list_transform(range(0, n), lambda i: ('0x' || substring(h, i * 2 + 1, 2))::UBIGINT) AS bytes FROM (
    SELECT word, hex(encode(word)) AS h, strlen(word) AS n FROM (SELECT DISTINCT word FROM words))),
parts AS (
  SELECT word, n, bytes, list_transform(range(0, n // 4), lambda i: {mixed(block('i * 4 + 1', 4))}) AS blocks FROM vocabulary),
mixes AS (SELECT word, xor(xor({step}, {last}), n::UBIGINT) AS a FROM parts),
second AS (SELECT word, {f1} AS b FROM mixes),
third AS (SELECT word, {f2} AS c FROM second),
buckets AS (SELECT word, xor(c, c // 65536) % {dimensions} AS bucket FROM third),
tf AS (SELECT chunk_id, bucket, count(*) AS tf FROM words JOIN buckets USING (word) GROUP BY ALL),
seen AS (SELECT bucket, count(*) AS n FROM tf WHERE chunk_id IN (SELECT chunk_id FROM {fitted}) GROUP BY bucket),
df AS (SELECT bucket, ln(((SELECT count(*) FROM {fitted}) + 1.0::DOUBLE) / (coalesce(n, 0) + 1)) AS idf
  FROM (SELECT DISTINCT bucket FROM tf) LEFT JOIN seen USING (bucket)),
raw AS (SELECT chunk_id, bucket, tf * idf AS w FROM tf JOIN df USING (bucket)),
norms AS (SELECT chunk_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY chunk_id),
weights AS (SELECT chunk_id, bucket, w / norm AS w FROM raw JOIN norms USING (chunk_id) WHERE w > 0)"""
