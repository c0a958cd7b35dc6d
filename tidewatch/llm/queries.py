"""Registered queries of the training-data operators over the driver tables.

Each query applies one operator with its production parameters to a whole table
and derives the contract's columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import centroids, chat, hamming, imatch, langid, language_model, minhash, mixing, packing, prefix_trie, secrets, toxicity, warc
from tidewatch.llm._shared import table


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents alike at 0.8 or more in two-word shingles."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document; sources weigh 1, 2, 3 in turn."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    m = mixing.mix(docs).select("doc_id", "source", "mix.*")
    return m.select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * F.size("draws")).cast("long").alias("taken"),
                    F.transform("draws", lambda d: d["shard"]).alias("shards"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length bucket and batch place of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs).select("doc_id", "pack.*")


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document, scanned once per distinct content."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, path_col="doc_id")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col("path").alias("doc_id"), n("assign").alias("n_assign"), n("access").alias("n_access"),
                        n("hex").alias("n_hex"), F.sha2(span_text(F.col("spans")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def op2_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 likelihood of every document under the recurrent model, and under word counts."""
    return language_model.language_scores(table(spark, sf_dir, "documents"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprint of every document and of its edited text."""
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through dictionary-compressed archives and back."""
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of the other folds."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the other folds."""
    return langid.language_id(table(spark, sf_dir, "documents"))


def op10_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation through its event log to a rendered text, read back from there."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(chat.probe(spark))
    back = chat.read_back(chat.chats(turns))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join("learned", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds of exact centroid clustering."""
    return centroids.with_inertia(*centroids.clusters(table(spark, sf_dir, "embeddings")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_gru": op2_gru,
    "op3_imatch": op3_imatch,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_toxicity": op6_toxicity,
    "op7_langid": op7_langid,
    "op8_minhash": op8_minhash,
    "op9_secrets": op9_secrets,
    "op10_hamming": op10_hamming,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_chat": op12_chat,
    "op13_centroids": op13_centroids,
}

ORACLES: dict[str, str] = {
    "op3_imatch": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),
        o AS (
          SELECT doc_id, text, n_chars,
                 coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
                 coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
          FROM t WINDOW w AS (ORDER BY doc_id)),
        e AS (
          SELECT *, left(text, n_chars - n_chars // 4) || left(next_text, n_chars // 4) AS edited FROM o),
        v AS (SELECT doc_id, 0 AS v, text AS x FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
        w AS (
          SELECT DISTINCT doc_id, v, unnest(regexp_extract_all(
            translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS term FROM v),
        lex AS (
          SELECT term, ('0x' || substr(md5(term), 1, 1))::INT AS subset, ('0x' || substr(md5(term), 2, 2))::INT AS value
          FROM w WHERE v = 0 GROUP BY term
          HAVING ln((SELECT count(*) FROM t)::DOUBLE / count(*)) BETWEEN 2.5 AND 6.5),
        s AS (
          SELECT doc_id, v, subset, r.rate, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 4) AS h
          FROM w JOIN lex USING (term)
          JOIN (SELECT unnest(range(0, 5)) AS rate) r
            ON r.rate <= (value < 1)::INT + (value < 4)::INT + (value < 16)::INT + (value < 64)::INT
          GROUP BY ALL),
        g AS (SELECT doc_id, v, rate, subset FROM (SELECT DISTINCT doc_id, v FROM s),
                     (SELECT unnest(range(0, 5)) AS rate), (SELECT unnest(range(0, 16)) AS subset)),
        p AS (
          SELECT doc_id, v, string_agg(coalesce(h, '----'), '' ORDER BY rate, subset) AS p
          FROM g LEFT JOIN s USING (doc_id, v, rate, subset) GROUP BY doc_id, v),
        f AS (
          SELECT e.doc_id, e.n_chars, e.next_id, sha256(e.edited) AS edited_sha256,
                 coalesce(p0.p, '=' || md5(e.text)) AS fingerprint, coalesce(p1.p, '=' || md5(e.edited)) AS edited_fingerprint
          FROM e LEFT JOIN p p0 ON p0.doc_id = e.doc_id AND p0.v = 0 LEFT JOIN p p1 ON p1.doc_id = e.doc_id AND p1.v = 1),
        c AS (
          SELECT doc_id, 'edited' AS what, fingerprint AS x, edited_fingerprint AS y FROM f
          UNION ALL
          SELECT f.doc_id, 'next', f.fingerprint, z.fingerprint FROM f JOIN f z ON z.doc_id = f.next_id),
        k AS (
          SELECT doc_id, what, x, y, r.rate,
                 len([j FOR j IN range(0, 16) IF substr(x, 64 * rate + 4 * j + 1, 4) <> '----' OR substr(y, 64 * rate + 4 * j + 1, 4) <> '----']) AS occupied,
                 len([j FOR j IN range(0, 16) IF substr(x, 64 * rate + 4 * j + 1, 4) <> '----'
                      AND substr(x, 64 * rate + 4 * j + 1, 4) = substr(y, 64 * rate + 4 * j + 1, 4)]) AS equal
          FROM c, (SELECT unnest(range(0, 5)) AS rate) r),
        l AS (
          SELECT doc_id, what, CASE WHEN x = y THEN 1.0 WHEN x[1] = '=' OR y[1] = '=' THEN 0.0
                 WHEN coalesce(sum(occupied) FILTER (occupied <= 10), 0) > 0
                 THEN (sum(equal) FILTER (occupied <= 10))::DOUBLE / sum(occupied) FILTER (occupied <= 10)
                 ELSE sum(equal)::DOUBLE / sum(occupied) END::DOUBLE AS near
          FROM k GROUP BY doc_id, what, x, y)
        SELECT f.doc_id, f.n_chars::BIGINT AS n_chars, edited_sha256, fingerprint, edited_fingerprint,
               l1.near AS near_edited, l2.near AS near_next
        FROM f JOIN l l1 ON l1.doc_id = f.doc_id AND l1.what = 'edited' JOIN l l2 ON l2.doc_id = f.doc_id AND l2.what = 'next'
    """,
    "op4_warc": r"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
        g AS (SELECT sha, max(page_id) AS last FROM p GROUP BY sha)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 1 + ((('0x' || substr(sha, 1 + 10 * (i // 8), 10))::UBIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)
                 FOR i IN range(0, 32)], '') AS payload_digest,
               CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = last THEN NULL ELSE last END AS refers_to
        FROM p JOIN g USING (sha)
    """,
    "op10_hamming": r"""
        WITH c AS (SELECT DISTINCT vec_id, [x > 0 FOR x IN embedding] AS code FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0),
        d AS (
          SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id,
                 list_sum([(q.code[i] <> r.code[i])::INT FOR i IN range(1, len(q.code) + 1)])::INT AS distance
          FROM c q JOIN c r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id))::INT AS rank,
               neighbor_id, distance
        FROM d QUALIFY rank <= 10
    """,
    "op11_prefix_trie": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        p AS (
          SELECT conv_id, sha256(length(role) || ':' || role || text) AS h,
                 len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS p FROM t),
        c AS (
          SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, list_reduce(
            [4294967295::UBIGINT] || [ord(ch)::UBIGINT FOR ch IN string_split(conv_id::VARCHAR, '')],
            lambda acc, byte: list_reduce([xor(acc, byte)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
              lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END)) AS crc FROM p),
        g AS (SELECT conv_id, base, (xor(crc, 4294967295::UBIGINT) % 4)::BIGINT AS n FROM c),
        s AS (
          SELECT g.conv_id, 0 AS own, b.p, b.h, b.words FROM g JOIN p b ON b.conv_id = g.base AND b.p <= g.n
          UNION ALL SELECT g.conv_id, 1, o.p, o.h, o.words FROM g JOIN p o ON o.conv_id = g.conv_id AND o.p > g.n),
        q AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d, h, words FROM s),
        k AS (
          SELECT conv_id, d, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY d) AS k, words FROM q
          UNION ALL SELECT conv_id, 0, '', 0 FROM g),
        l AS (SELECT *, lag(k) OVER w AS parent, d = max(d) OVER (PARTITION BY conv_id) AS last FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY d)),
        n AS (
          SELECT d, k, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
          FROM l GROUP BY d, k),
        ch AS (SELECT d - 1 AS d, parent AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
        v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (d, k)),
        sums AS (
          SELECT a.d, a.k, sum((v.n_children = 0)::INT)::BIGINT AS n_leaves, sum((v.n_convs - 1) * v.words)::BIGINT AS saved_tokens
          FROM v JOIN k a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY a.d, a.k)
        SELECT v.conv_id, v.d::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children, n_leaves, saved_tokens,
               v.ends_sha256
        FROM v JOIN sums USING (d, k) LEFT JOIN n u ON u.d = v.d - 1 AND u.k = v.parent
    """,
    "op12_chat": r"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(0, 2) r(i)),
        p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM t),
        n AS (
          SELECT *, length(role || text) + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
                 + len(regexp_extract_all(role || chr(10) || text, '\[/?INST\]|</s>')) AS chars FROM p)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars + 17)::BIGINT AS formatted_chars
        FROM n GROUP BY conv_id
    """,
    "op8_minhash": r"""
        WITH RECURSIVE toks AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        sh AS (
          SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]]
                 ELSE [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s
          FROM toks WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        pairs AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
          FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
          SELECT p.a, p.b FROM pairs p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
          WHERE 100 * common >= 80 * (x.n + y.n - common)),
        reach(node, root) AS (
          SELECT doc_id, doc_id FROM documents
          UNION
          SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node)
        SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) c ON c.node = d.doc_id
    """,
    "op9_secrets": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        m AS (
          SELECT doc_id, 0 AS rank, 'assign' AS kind, 12 AS least,
                 string_split_regex(text, '(?:(?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?(?:[A-Za-z0-9+/_.=-]+)') AS gaps,
                 regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) AS w,
                 regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) AS g FROM t
          UNION ALL
          SELECT doc_id, 1, 'access', 18, string_split_regex(text, 'AKIA[A-Z0-9]+'),
                 regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(text, 'AKIA[A-Z0-9]+', 0) FROM t
          UNION ALL
          SELECT doc_id, 2, 'hex', 16, string_split_regex(text, '[0-9a-f]+'),
                 regexp_extract_all(text, '[0-9a-f]+', 0), regexp_extract_all(text, '[0-9a-f]+', 0) FROM t),
        e AS (
          SELECT doc_id, rank, kind, least, unnest(range(1, len(w) + 1)) AS i, unnest(gaps[1:len(w)]) AS gap,
                 unnest(w) AS w, unnest(g) AS g FROM m WHERE len(w) > 0),
        s AS (
          SELECT doc_id, rank, kind, least, g, length(w) AS width,
                 sum(length(gap) + length(w)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop FROM e),
        k AS (
          SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                 count(*) FILTER (kind = 'hex') AS n_hex,
                 string_agg(kind || ':' || (stop - width) || ':' || stop, ',' ORDER BY stop - width, rank) AS spans
          FROM s WHERE length(g) >= least GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
               coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM t LEFT JOIN k USING (doc_id)
    """,
}
