"""The registered queries of the corpus operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_cnn, embed_caps, exact_dedup, language_id, line_runs, mixing, ngram_join, packing, pieces, pii, secret_scan, turn_repair, vector_codes
from millrace.llm.common import fresh_dir, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def put(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


_BASE_SPANS = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
 k AS (
  SELECT doc_id, 0 AS kind, 'assign' AS name, 6 AS least,
   regexp_split_to_array(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS gaps,
   regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') AS hits,
   regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) AS vals FROM d
  UNION ALL SELECT doc_id, 1, 'access', 20, regexp_split_to_array(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT doc_id, 2, 'hex', 24, regexp_split_to_array(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d),
 e AS (SELECT doc_id, kind, name, least, unnest(range(1, len(hits) + 1)) AS i, unnest(gaps[:len(hits)]) AS gap, unnest(hits) AS hit, unnest(vals) AS val FROM k),
 s AS (SELECT doc_id, kind, name, least, hit, val, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
 o AS (SELECT doc_id, kind, CAST(stop - length(hit) AS BIGINT) AS start,
   name || ':' || CAST(CAST(stop - length(hit) AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(stop AS BIGINT) AS VARCHAR) AS said FROM s WHERE length(val) >= least),
 g AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
   string_agg(said, ',' ORDER BY start, kind) AS spans FROM o GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
 sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""


@register("op1_secret_scan", _BASE_SPANS)
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one version of one path, against a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_versions(docs, fresh_dir(spark, "ledger"), content="text", first_run=True)
    return found.select("doc_id", *secret_scan.digest(found))


_EXACT = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
 r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS k, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, h AS text_sha256 FROM r
"""


@register("op3_exact_dedup", _EXACT)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"))


_LINES = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
 e AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS line FROM d),
 k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
 r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
 j AS (SELECT k.*, r.key IS NOT NULL AND doc_id <> keeper AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id
"""


@register("op5_line_dedup", _LINES)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.dedup(docs, keep_text=False).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _remainder(column: str, parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


@register("op2_language_id")
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the documents whose remainder by 4 is not 2; predict all of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.select("doc_id", "text", "lang"), ~held_out)
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep_text=False)


@register("op6_quality_classifier")
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the labels whose remainder by 3 is not 1; score all documents."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(_remainder("doc_id", 3) == 1, F.lit(False))
    model = byte_cnn.fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), ~held_out)
    return byte_cnn.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep_text=False)


#: The share of all tokens that a mixture is to have.
WANTED = 0.5


@register("op10_mixing")
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources and languages to their token shares to the power 0.7, topics as they are; half of all tokens is wanted. Every
    document with its draw."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    out = mixing.mix(docs, keep_text=False, share=WANTED)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", F.round("prob", 6).alias("prob"), F.round("draw", 6).alias("draw"), "drawn", F.round("margin_error", 6).alias("margin_error"), F.round("drawn_error", 6).alias("drawn_error"))


#: The vocabulary file; the environment variable names another one.
PIECE_MODEL = os.environ.get("MILLRACE_PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def piece_model(path: str = PIECE_MODEL) -> bytes:
    """The bytes of the vocabulary file, read on the driver and broadcast."""
    with open(path, "rb") as f:
        return f.read()


@register("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, piece_model(), keep_text=False)


_JACCARD = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
   ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
 e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""


@register("op7_ngram_jaccard", _JACCARD)
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_components(docs, params=ngram_join.Params(width=3, percent=90)).drop("kept")


_LINKS = _JACCARD[: _JACCARD.index(",\n r AS (")] + """
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, count(e.b) AS n_links FROM d LEFT JOIN n USING (doc_id) LEFT JOIN e ON e.a = d.doc_id GROUP BY d.doc_id
"""


@register("op7_ngram_links", _LINKS)
def op7_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of all links of every document, also within a component."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_links(docs, params=ngram_join.Params(width=3, percent=90))[1].select("doc_id", "n_shingles", "n_links")


_CAPS = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 g AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
 r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
 c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
 n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept FROM v JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""


@register("op4_embedding_neardup", _CAPS)
def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_caps.near_components(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@register("op8_pii")
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the key from spark.millrace.pii.key or MILLRACE_PII_KEY; the synthetic tables need no secret one."""
    key = spark.conf.get("spark.millrace.pii.key", None) or os.environ.get("MILLRACE_PII_KEY") or "key of the synthetic tables"
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key=key)


def damage(conv: Column, turn: Column, role: Column, text: Column) -> tuple[Column, Column, Column]:
    """The faults of op12: by crc32 modulo 20, 0 drops a row, 1 empties its text, 2 takes its full stops, 3 repeats it, 4 makes it a user's."""
    said = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)]
    fault = F.pmod(F.crc32(F.concat_ws(":", *said).cast("binary")), F.lit(20))
    texts = F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    return F.when(fault == 4, F.lit("user")).otherwise(role), texts, F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)


def _turns_sql() -> str:
    """A best (cost, audit) for each of the four automaton states, carried from row to row; cost in nine digits, so that texts compare."""

    def plus(c: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST(left({c}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({c}, 10) || '{letter}'"

    def best(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def kept(c: str, initial: str) -> str:
        return f"CASE WHEN f < 2 AND i = '{initial}' THEN {plus(c, 'f', 'K')} END"

    def reroled(c: str) -> str:
        return f"CASE WHEN f < 2 THEN {plus(c, '2 + f', 'R')} END"

    x2 = best("c2", *(plus(c, "2", "I") for c in ("c0", "c1", "c3")))
    closed = f"SELECT *, {best('c3', plus('x2', '2', 'I'))} AS x3 FROM (SELECT *, {x2} AS x2 FROM r)"
    n1 = best(plus("c1", "3", "D"), kept("c0", "s"))
    n2 = best(plus("x2", "3", "D"), *(y for c in ("c0", "c1", "x3") for y in (kept(c, "u"), reroled(c))))
    n3 = best(plus("x3", "3", "D"), kept("x2", "a"), reroled("x2"))
    return rf"""
WITH RECURSIVE k AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS said,
   coalesce(role, ' ') AS r0, coalesce(text, ' ') AS t0 FROM conversations),
 f AS (SELECT *, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(said, ''), lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
   lambda c, o: CASE WHEN o >= 0 THEN xor(c, o) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 20 AS fault FROM k),
 g AS (SELECT conv_id, turn, r0, t0, CASE WHEN fault = 4 THEN 'user' ELSE r0 END AS role,
   CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(t0, '[.!?]', '', 'g') ELSE t0 END AS text,
   unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM f),
 o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r0, left(t0, 64), sha256(t0), copy) AS n FROM g),
 p AS (SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 3
   WHEN regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 0 ELSE 1 END AS f FROM o),
 q AS (SELECT *, n > 1 AND coalesce(lag(i) OVER (PARTITION BY conv_id ORDER BY n) || i, '') NOT IN ('su', 'ua', 'au') AS odd FROM p),
 s AS (SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 2) AS blank, count(*) FILTER (f = 3) AS duplicate,
   count(*) FILTER (f = 1) AS truncated, count(*) FILTER (odd) AS illegal FROM q GROUP BY conv_id),
 r AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, '000000000' AS c0, CAST(NULL AS VARCHAR) AS c1, CAST(NULL AS VARCHAR) AS c2, CAST(NULL AS VARCHAR) AS c3 FROM s
  UNION ALL SELECT x.conv_id, q.n, {plus("c0", "3", "D")}, {n1}, {n2}, {n3} FROM ({closed}) x JOIN q ON q.conv_id IS NOT DISTINCT FROM x.conv_id AND q.n = x.pos + 1),
 e AS (SELECT x.conv_id, {best("c0", "x3")} AS said FROM ({closed}) x JOIN s ON s.conv_id IS NOT DISTINCT FROM x.conv_id AND s.rows = x.pos),
 a AS (SELECT conv_id, CAST(left(said, 9) AS BIGINT) AS cost, substr(said, 10) AS audit FROM e),
 l AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS pos, unnest(string_split(audit, '')) AS letter FROM a WHERE audit <> ''),
 m AS (SELECT *, count(*) FILTER (letter <> 'I') OVER w AS n, count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY pos DESC) AS back FROM l WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
 h AS (SELECT m.conv_id, string_agg(CASE WHEN letter = 'K' THEN q.role WHEN back % 2 = 1 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE q.text END, chr(10) ORDER BY pos) AS repaired
   FROM m LEFT JOIN q ON q.conv_id IS NOT DISTINCT FROM m.conv_id AND q.n = m.n WHERE letter <> 'D' GROUP BY m.conv_id),
 c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
 coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""


@register("op12_turn_repair", _turns_sql())
def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, damaged by a rule, and their cheapest repairs."""
    return turn_repair.audit(table(spark, sf_dir, "conversations"), damage=damage)


def _codes_sql(rounds: int = 4) -> str:
    """Rounds as one subquery each: (part, entry, c) are codebooks, (i, part, entry, err) assignments of the rows numbered i."""

    def assigned(books: str) -> str:
        return f"""(SELECT i, part, (best).entry AS entry, (best).err AS err FROM (SELECT p.i, p.part, min({{'err': list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'entry': b.entry}}) AS best
   FROM p JOIN {books} b ON p.part = b.part GROUP BY p.i, p.part))"""

    steps = ""
    for k in range(rounds):
        steps += f""",
 a{k} AS MATERIALIZED {assigned(f"b{k}")},
 m{k} AS (SELECT part, entry, list(CAST(floor(s / n) AS BIGINT) ORDER BY j) AS c FROM (SELECT part, entry, j, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
   FROM (SELECT a.part, a.entry, unnest(p.x) AS v, unnest(range(1, len(p.x) + 1)) AS j FROM a{k} a JOIN p ON p.i = a.i AND p.part = a.part) GROUP BY part, entry, j) GROUP BY part, entry),
 b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry)"""
    return rf"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i FROM embeddings
   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 p AS MATERIALIZED (SELECT i, k AS part, x[k * len(x) // 4 + 1 : (k + 1) * len(x) // 4] AS x FROM v, (SELECT unnest([0, 1, 2, 3]) AS k)),
 b0 AS MATERIALIZED (SELECT part, i - 1 AS entry, x AS c FROM p WHERE i <= 256){steps},
 z AS MATERIALIZED {assigned(f"b{rounds}")},
 c AS (SELECT i, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(err) AS BIGINT) AS error FROM z GROUP BY i),
 h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM v JOIN c USING (i), h
"""


@register("op11_vector_codes", _codes_sql())
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codebooks fitted on all vectors, and every vector's code."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.train(vectors)
    coded = vector_codes.with_group_error(vector_codes.encode(vectors, books, also=("label",)))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


def word_tokenizer(name: str = "word_bpe_49k.json") -> bytes:
    """The bytes of a public tokenizer file, read on the driver and broadcast; MILLRACE_WORD_TOKENIZER names another file."""
    import public_tokenizers

    with open(os.environ.get("MILLRACE_WORD_TOKENIZER") or public_tokenizers.path(name), "rb") as f:
        return f.read()


@register("op13_packing")
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), word_tokenizer())
