"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.llm.decontaminate import contamination
from gaugeframe.llm.language import identify_language
from gaugeframe.llm.mixing import mix_sources
from gaugeframe.llm.near_copies import near_copies
from gaugeframe.llm.paragraphs import repeated_paragraphs
from gaugeframe.llm.pii import find_personal_data
from gaugeframe.llm.quality import resample
from gaugeframe.llm.sentencepiece_bpe import Pieces, decode, encode
from gaugeframe.llm.spelling import count_words, spelling_variants
from gaugeframe.llm.toxicity import toxicity
from gaugeframe.llm.vectors import link_vectors
from gaugeframe.llm.warc import as_records, read_warc, write_warc
from gaugeframe.llm.whitening import whitened_components
from gaugeframe.sources.scratch import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(as_records(_table(spark, sf_dir, "pages")), path)
    return read_warc(spark, path, payload=False).select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"), "verified")


def op2_mix_sources(spark, sf_dir) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op3_near_copies(spark, sf_dir) -> DataFrame:
    return near_copies(_table(spark, sf_dir, "documents"), size=2)


def op4_resample(spark, sf_dir) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_paragraphs(spark, sf_dir) -> DataFrame:
    return repeated_paragraphs(_table(spark, sf_dir, "documents"))


def op6_language(spark, sf_dir) -> DataFrame:
    return identify_language(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_decontaminate(spark, sf_dir) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_link_vectors(spark, sf_dir) -> DataFrame:
    return link_vectors(_table(spark, sf_dir, "embeddings"))


def op10_personal_data(spark, sf_dir) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark, sf_dir, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = Pieces.read(model)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decode(encode(docs, pieces).select("doc_id", "ids"), pieces)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_spelling(spark, sf_dir) -> DataFrame:
    return spelling_variants(count_words(_table(spark, sf_dir, "documents"), misspell=97))


def op13_whitening(spark, sf_dir) -> DataFrame:
    found = whitened_components(_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP1 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS d FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY d) AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((CAST('0x' || substr(d, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS INT)
             >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS verified
FROM g"""

_OP3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(
        range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
f AS (SELECT g, count(*) AS f FROM s GROUP BY g),
r AS (SELECT s.doc_id, s.g, n.n,
             row_number() OVER (PARTITION BY s.doc_id ORDER BY f.f, s.g) AS r
      FROM s JOIN n USING (doc_id) JOIN f USING (g)),
-- Two sets at 0.8 share one of the rarest fifth of their shingles.
rare AS (SELECT * FROM r WHERE r <= n - (80 * n + 99) // 100 + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM rare a JOIN rare b USING (g)
         WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
common AS (SELECT c.a, c.b, count(*) AS k FROM cand c JOIN s x ON x.doc_id = c.a
           JOIN s y ON y.doc_id = c.b AND y.g = x.g GROUP BY c.a, c.b),
link AS (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
         WHERE 100 * k >= 80 * (p.n + q.n - k)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id AS id, doc_id AS c FROM documents
          UNION SELECT l.b, t.c FROM reach t JOIN both_ways l ON l.a = t.id),
least_id AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, l.c AS component_id, d.doc_id = l.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN least_id l ON l.id = d.doc_id"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP8 = rf"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
x AS (SELECT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w]
        ELSE list_transform(range(1, len(w) - 8), lambda k: w[k:k + 9]) END) AS x FROM i),
win AS (SELECT DISTINCT item_id, len(x) AS size, array_to_string(x, ' ') AS g FROM x),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
place AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
          FROM d, (SELECT DISTINCT size FROM win) z),
hit AS (SELECT p.doc_id, p.k, p.size, win.item_id FROM place p
        JOIN win ON win.size = p.size AND win.g = array_to_string(w[k:k + p.size - 1], ' ')),
pos AS (SELECT doc_id, count(*) AS n FROM (
          SELECT DISTINCT doc_id, unnest(range(k, k + size)) AS at FROM hit) t GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, sha256(string_agg(t, ',' ORDER BY t)) AS sha FROM (
          SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) t GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(pos.n, 0) AS n_hit,
       coalesce(ids.n, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       pos.n IS NOT NULL AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)"""

_OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
         ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) >= 0.98 * sqrt(list_dot_product(a.e, a.e))
               * sqrt(list_dot_product(b.e, b.e))
           AND list_dot_product(a.e, a.e) > 0 AND list_dot_product(b.e, b.e) > 0),
reach AS (SELECT vec_id AS id, vec_id AS c FROM v
          UNION SELECT l.b, t.c FROM reach t JOIN link l ON l.a = t.id),
least_id AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n.n, 0) AS n_links, c AS component_id, vec_id = c AS kept
FROM v JOIN least_id ON id = vec_id LEFT JOIN n ON a = vec_id"""

_OP12 = """
WITH RECURSIVE
tab AS (SELECT list(list_reduce([b] || range(0, 8), lambda c, k:
          CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS tab
        FROM range(0, 256) r(b)),
run AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
seen AS (SELECT doc_id, run, count(*) AS k FROM run GROUP BY doc_id, run),
coded AS (SELECT run, k, flatten(list_transform(
            string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)]
              ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), 128 + (unicode(x) & 63)] END)) AS b FROM seen),
hashed AS (SELECT run, k, xor(list_reduce([4294967295] || b, lambda c, x:
             xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM coded, tab),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run))
           || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT DISTINCT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS g
        FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w) t),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (i, g) WHERE a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cut a JOIN w b ON b.word = a.g
         UNION SELECT b.word, a.word, a.n FROM cut a JOIN w b ON b.word = a.g),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS form,
                max(near_n) AS form_n FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
             CASE WHEN form_n >= 2 * n THEN form END AS form,
             CASE WHEN form_n >= 2 * n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM f
          UNION ALL SELECT c.word, f.form FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
root AS (SELECT c.word, c.root FROM chain c JOIN f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, root.root, f.n, f.n_near, f.form_n FROM f JOIN root USING (word)"""

QUERIES = {f.__name__: f for f in (
    op1_warc, op2_mix_sources, op3_near_copies, op4_resample, op5_paragraphs, op6_language, op7_toxicity, op8_decontaminate,
    op9_link_vectors, op10_personal_data, op11_sentencepiece, op12_spelling, op13_whitening)}

ORACLES = {"op1_warc": _OP1, "op3_near_copies": _OP3, "op8_decontaminate": _OP8,
           "op9_link_vectors": _OP9, "op12_spelling": _OP12}
