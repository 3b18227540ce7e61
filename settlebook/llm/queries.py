"""Registered queries of the ten operators: thin digests of their results.

Each query reads its whole table, applies the operator with its production
parameters and returns the columns its contract names.
"""

from __future__ import annotations

import functools
import re

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlebook.llm.scratch import Scratch, table
from settlebook.shipping import ship


def op1_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set, its component, whether it stays."""
    from settlebook.llm.near import link
    return link(table(spark, sf_dir, "documents"), Scratch(spark, "op1")).drop("th")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the ids and of the decoded bytes."""
    from settlebook.llm.bpe import encode_decode
    coded = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text and the number of its code points."""
    from settlebook.llm.html import extract
    return extract(table(spark, sf_dir, "pages"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: length, digest and kind of its record, as read back from the archive."""
    from settlebook.llm import warc
    scratch = Scratch(spark, "op4")
    path, run = warc.write(table(spark, sf_dir, "pages"), scratch)
    return warc.read(scratch, path, run).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: base counts, the base verdict and the verdict of all rules."""
    from settlebook.llm.quality import judge
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the document that stays for its text, the size of its group, its digest."""
    from settlebook.llm.exact import dedup
    return dedup(table(spark, sf_dir, "documents"), Scratch(spark, "op6")).drop("rid")


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of words, of removed words, and a digest of the kept ones."""
    from settlebook.llm.substring import dedup
    return dedup(table(spark, sf_dir, "documents"), Scratch(spark, "op7")).drop("spans")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: counts and digest of the base spans, and all spans."""
    from settlebook.llm.pii import BASE, KINDS, described, find
    found = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)

    def count(k: str):
        return F.size(F.filter("base", lambda s: s.kind == KINDS.index(k))).cast("long").alias(f"n_{k}")

    counts = [count(k) for k in BASE]
    return found.withColumn("base", base).select("doc_id", *counts, F.sha2(described(F.col("base")), 256).alias("base_sha256"),
                                                 described(F.col("spans")).alias("spans"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece: its ids' place in its document, their checksum, and its place in a sequence."""
    from settlebook.llm.packing import pack, token_pieces
    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pack(pieces, Scratch(spark, "op9"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: predicted language and its score, and whether the document was held out."""
    from settlebook.llm.langid import fit, predict
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return predict(docs, fit(docs)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: the commoner word that it is a variant of, the last of such, and its near words."""
    from settlebook.llm.spelling import group
    return group(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf, subroot and root, a digest of its proof, and whether it still folds to the root."""
    from settlebook.llm.merkle import manifest
    found = manifest(table(spark, sf_dir, "documents"), Scratch(spark, "op12"))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    from settlebook.llm.mixing import mix
    return mix(table(spark, sf_dir, "documents"), Scratch(spark, "op13")).drop("copies")


def _shipped(query):
    """The query, after the session's executors have been sent this package."""
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    return run


def queries() -> dict:
    return {f.__name__: _shipped(f) for f in (op1_near, op2_bpe, op3_html, op4_warc, op5_quality, op6_exact, op7_substring, op8_pii, op9_packing,
                                              op10_language, op11_spelling, op12_merkle, op13_mixing)}


OP1_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                          ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT r.doc_id, coalesce(n, 0) AS n_shingles, component_id, r.doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r LEFT JOIN n ON n.doc_id = r.doc_id
"""

OP7_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY md5(g)) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(50)) AS k FROM hits)),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM t),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS x FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN m USING (payload_digest)
"""

OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)),
repeated AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(8)) AS k FROM repeated WHERE c > 1)
            GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(t) - length(replace(t, '!', '')) AS n_exclamations, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^\s*[•▪◦*\-–]\s'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '(?:\.\.\.|…)\s*$'))) AS n_cut_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
         len(list_filter(w, lambda x: regexp_matches(lower(x), '^(?:STOP_WORDS)(?:[.,;:!?]|$)'))) AS n_stop_words,
         coalesce(c.n, 0) AS n_repeat_words
  FROM t LEFT JOIN covered c USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false ELSE VERDICT END AS kept
FROM f
"""

OP6_SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


OP11_SQL = r"""
WITH bits AS (SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
                          ORDER BY c) AS tab FROM (SELECT CAST(range AS BIGINT) AS c FROM range(256))),
found AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents),
own AS (SELECT doc_id, w, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM found WHERE length(w) >= 5 GROUP BY doc_id, w),
summed AS (SELECT w, n, xor(list_reduce(list_transform(range(0, length(x), 2), lambda i: CAST('0x' || x[i + 1:i + 2] AS BIGINT)),
                                        lambda h, b: xor(h >> 8, tab[(xor(h, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM own, bits),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM summed) GROUP BY word HAVING length(word) >= 5 AND sum(n) >= 3),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
gone AS (SELECT DISTINCT word, n, word[:i - 1] || word[i + 1:] AS rest FROM cut),
replaced AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b
             ON a.i = b.i AND a.word[:a.i - 1] || ' ' || a.word[a.i + 1:] = b.word[:b.i - 1] || ' ' || b.word[b.i + 1:] AND a.word <> b.word),
dropped AS (SELECT g.word, g.n, w.word AS near, w.n AS near_n FROM gone g JOIN words w ON g.rest = w.word),
near AS (SELECT * FROM replaced UNION ALL SELECT * FROM dropped UNION ALL SELECT near, near_n, word, n FROM dropped),
best AS (SELECT word, count(*) AS n_near, min({'m': -near_n, 'w': near}) AS b FROM near GROUP BY word),
formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 2 * n THEN b.w END AS form, CASE WHEN -b.m >= 2 * n THEN -b.m END AS form_n
           FROM words LEFT JOIN best USING (word)),
chain AS (WITH RECURSIVE c AS (SELECT word, word AS stop FROM formed UNION ALL SELECT c.word, f.form FROM c JOIN formed f ON c.stop = f.word WHERE f.form IS NOT NULL) SELECT * FROM c)
SELECT word, form, stop AS root, n, n_near, form_n FROM formed JOIN (SELECT c.word, c.stop FROM chain c JOIN formed f ON c.stop = f.word WHERE f.form IS NULL) USING (word)
"""


def op12_sql(levels: int = 7) -> str:
    """Level by level for groups of at most 8^levels rows, and as many groups."""
    part = "coalesce(strlen({0}) || ':' || {0}, '-')".format
    leaf = "sha256({} || {} || {} || {} || {{}})".format(*map(part, ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)"))).format
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [f"""
WITH bits AS (SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
                          ORDER BY c) AS tab FROM (SELECT CAST(range AS BIGINT) AS c FROM range(256))),
doc AS (SELECT *, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                                  lambda h, b: xor(h >> 8, tab[(xor(h, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h FROM documents, bits),
leaves AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf(part('text'))} AS leaf, CASE WHEN h % 3 = 0 THEN {leaf(part(lower))} END AS changed FROM doc),
p0 AS (SELECT *, leaf AS d, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY g) AS n FROM leaves)"""]
    for tree, keys in (("p", "g, n"), ("t", "n")):
        for k in range(levels):
            ds = f"{tree}{k}b AS (SELECT {keys}, r // 8 AS q, list(d ORDER BY r) AS ds FROM {tree}{k} GROUP BY ALL)"
            up = f"{tree}{k + 1} AS (SELECT {keys}, q AS r, CASE WHEN n > {8**k} THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM {tree}{k}b)"
            steps += [ds, up]
        if tree == "p":
            steps.append(f"t0 AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n FROM p{levels})")
    found = "z0 AS (SELECT p0.*, t0.r AS tr, t0.n AS tn, t0.d AS subroot, '' AS proof, coalesce(changed, leaf) AS f FROM p0 JOIN t0 USING (g))"
    steps.append(found)
    z = 0
    for tree, r, n, on in (("p", "r", "n", "b.g = z.g AND"), ("t", "tr", "tn", "")):
        for k in range(levels):
            i = f"(z.{r} // {8**k} % 8)"
            left, right = f"array_to_string(ds[:{i}], '')", f"array_to_string(ds[{i} + 2:], '')"
            steps.append(f"""z{z + 1} AS (SELECT z.* EXCLUDE (proof, f), proof || {left} || {right} AS proof,
    CASE WHEN z.{n} > {8**k} THEN sha256({left} || f || {right}) ELSE f END AS f FROM z{z} z JOIN {tree}{k}b b ON {on} b.q = z.{r} // {8**(k + 1)})""")
            z += 1
    return ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, (SELECT d FROM t{levels}) AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT d FROM t{levels}) AS verified
FROM z{z}"""


OP13_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('0' || source, '1') AS s, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT s, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY s) - 1) % 3 + 1] AS w FROM d GROUP BY s),
share AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
                 sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS o FROM src WINDOW o AS (ORDER BY source_size / w, s)),
level AS (SELECT l, o FROM share WHERE 3 * source_size * o >= w * l ORDER BY source_size / w, s LIMIT 1),
goal AS (SELECT s, source_size, CASE WHEN 3 * source_size * level.o < w * level.l THEN CAST(3 * source_size AS DOUBLE)
                                     ELSE CAST(w AS DOUBLE) * CAST(level.l AS DOUBLE) / CAST(level.o AS DOUBLE) END AS target,
                CAST('0x' || md5('mix:' || s)[:5] AS HUGEINT) AS shift FROM src, level),
sizes AS (SELECT s, size, count(*) AS m FROM d GROUP BY s, size),
ladder AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY size DESC) AS k, sum(m * size) OVER (PARTITION BY s ORDER BY size) AS rest FROM sizes),
walk AS (
  SELECT s, 0 AS k, CAST(0 AS BIGINT) AS size, CAST(0 AS HUGEINT) AS rate, shift AS before, shift AS after, CAST(0 AS HUGEINT) AS taken FROM goal
  UNION ALL
  SELECT s, k, size, rate, before, before + m * rate, taken + ((before + m * rate) // 1048576 - before // 1048576) * size FROM (
    SELECT x.s, y.k, y.size, y.m, x.after AS before, x.taken,
           CASE WHEN rest = 0 THEN 0 ELSE least(3 * 1048576, greatest(0, CAST(floor(target + 0.5) AS HUGEINT) - x.taken) * 1048576 // CAST(rest AS HUGEINT)) END AS rate
    FROM walk x JOIN ladder y ON y.s = x.s AND y.k = x.k + 1 JOIN goal ON goal.s = x.s)),
placed AS (SELECT *, row_number() OVER (PARTITION BY s, size ORDER BY doc_id) - 1 AS place FROM d)
SELECT doc_id, size, source_size, target,
       CAST(((before + (place + 1) * rate) // 1048576 - (before + place * rate) // 1048576) * size AS BIGINT) AS taken
FROM placed JOIN walk USING (s, size) JOIN goal USING (s) WHERE k > 0
"""


def oracle_sql() -> dict[str, str]:
    from settlebook.llm.quality import STOP_WORDS, verdict
    op5 = OP5_SQL.replace("STOP_WORDS", "|".join(STOP_WORDS)).replace("VERDICT", re.sub(r"(?<=[0-9])D\b", "", verdict()))
    return {"op1_near": OP1_SQL, "op7_substring": OP7_SQL, "op4_warc": OP4_SQL, "op5_quality": op5, "op6_exact": OP6_SQL, "op11_spelling": OP11_SQL, "op12_merkle": op12_sql(), "op13_mixing": OP13_SQL}
