"""The numbered queries over `documents`, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import bounded_batches


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's MinHash fingerprint against its edited text's and the next document's; its class of equal texts and that class's verified near links."""
    from .fingerprints import compare_with_edited, near_duplicate_links

    docs = _documents(spark, sf_dir)
    return compare_with_edited(docs, links=near_duplicate_links(docs))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's number of token ids, and the digests of its ids and of their decoded text."""
    import public_tokenizers

    from .sentencepiece_bpe import encode_decode

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's probability of label toxic = 1 by weak supervision, and the prediction at PREDICT_AT."""
    from .samples import id_remainder
    from .toxicity import HELD, HELD_DIVISOR, PREDICT_AT, fit_documents, score_documents

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = score_documents(docs, fit_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), HELD_DIVISOR) == HELD).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= PREDICT_AT).cast("int").alias("predicted"),
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's probability of label quality = 1 by attention over its passages, and the prediction at PREDICT_AT."""
    from .quality import HELD, HELD_DIVISOR, PREDICT_AT, fit_documents, score_documents
    from .samples import id_remainder

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = score_documents(docs, fit_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), HELD_DIVISOR) == HELD).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= PREDICT_AT).cast("int").alias("predicted"),
    )


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document stored as AVI and read back: sizes, digests, and its timed clips."""
    from .media import media_digests

    return media_digests(_documents(spark, sf_dir))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's nearest language by centroids, its score, and whether it is too far from all."""
    from .langid import HELD_DIVISOR, fit_documents, identify
    from .samples import id_remainder

    docs = _documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), fit_documents(docs))
    return found.select(
        "doc_id",
        (id_remainder(F.col("doc_id"), HELD_DIVISOR) == 0).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_rejected").alias("rejected"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's spans of personal data, with the counts and digest of the base kinds."""
    from .pii import pii_digests

    return pii_digests(_documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's SimHash fingerprint and its component of fingerprints at three or fewer differing bits."""
    from .simhash import near_duplicates

    found = near_duplicates(_documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shard of 40 of near equal bytes, and its place there."""
    from .sharding import ROW_BYTES, shard_documents

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    placed = shard_documents(docs, shards=40)
    return placed.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's words taken by the mix, and the slots of the schedule that take them."""
    from .mixing import mix_documents

    mixed = mix_documents(_documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "slots")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item by weighted terms."""
    from .search import ranked

    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return ranked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def op12_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's log10 probability by prediction by partial matching, beside that of word frequencies."""
    from .ppm import score_documents

    return score_documents(_documents(spark, sf_dir).select("doc_id", "text"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each damaged conversation's faults and the cheapest edits that mend it, with the digest of what they give."""
    from .conversations import damaged, repair_digests, repair_plans

    bounded_batches(spark)
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return repair_digests(rows, repair_plans(rows))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_fingerprints": op1_fingerprints, "op2_sentencepiece": op2_sentencepiece, "op3_toxicity": op3_toxicity, "op4_quality": op4_quality, "op5_media": op5_media, "op6_langid": op6_langid, "op7_pii": op7_pii, "op8_simhash": op8_simhash, "op9_sharding": op9_sharding, "op10_mixing": op10_mixing, "op11_search": op11_search, "op12_ppm": op12_ppm, "op13_conversations": op13_conversations}


#: CRC-32 by nibbles, low one first: the remainders of the 16 nibbles by the reversed polynomial EDB88320.
def _crc_nibble(n: int) -> int:
    for _ in range(4):
        n = (n >> 1) ^ (0xEDB88320 * (n & 1))
    return n


_SQL_SHARDING = f"""
WITH k AS (
  SELECT doc_id, coalesce(text, '') AS body, octet_length(encode(coalesce(text, ''))) + 16 AS size,
         coalesce(('0x' || substr(md5(text), 1, 15))::BIGINT, 0) AS k1,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k2
  FROM documents),
s AS (SELECT *, coalesce(sum(size) OVER (ORDER BY k1, k2 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             sum(size) OVER () AS total FROM k),
p AS (SELECT *, CAST(least(39, floor(before * 40.0 / total)) AS INTEGER) AS shard, hex(encode(body)) AS digits FROM s)
SELECT doc_id, size::BIGINT AS size,
       CAST(xor(4294967295::BIGINT, list_reduce(
         list_transform(range(length(digits)), lambda i: (instr('0123456789ABCDEF', substr(digits, i + 1 + 1 - 2 * (i % 2), 1)) - 1)::BIGINT),
         lambda c, d: xor(c >> 4, [{", ".join(f"{_crc_nibble(n)}::BIGINT" for n in range(16))}][1 + (xor(c, d) & 15)]),
         4294967295::BIGINT)) AS BIGINT) AS text_crc32,
       'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY k2, doc_id) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM p
"""

_SQL_MIXING = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight FROM g),
c AS (SELECT *, (SELECT sum(source_size) FROM w) - coalesce(sum(3 * source_size) OVER o, 0) AS rest,
             (SELECT sum(weight) FROM w) - coalesce(sum(weight) OVER o, 0) AS weights, 3.0 * source_size / weight AS ratio
      FROM w WINDOW o AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT rest::DOUBLE / weights::DOUBLE AS level FROM c WHERE weight * (rest::DOUBLE / weights::DOUBLE) < 3 * source_size ORDER BY ratio, source LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN weight * level >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE weight * level END AS target
      FROM w, l),
p AS MATERIALIZED (SELECT row_number() OVER () AS row, d.doc_id, d.source, d.size, t.source_size, t.target,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
s AS (SELECT source, source_size, floor(target)::BIGINT AS whole, ceil(source_size / {words}.0)::BIGINT AS per_use,
             (floor(target)::BIGINT // source_size) * ceil(source_size / {words}.0)::BIGINT + ceil((floor(target)::BIGINT % source_size) / {words}.0)::BIGINT AS slots
      FROM t WHERE source_size > 0),
b AS (SELECT *, (sum(slots) OVER (ORDER BY encode(source) NULLS LAST))::BIGINT AS until, sum(slots) OVER ()::BIGINT AS n FROM s WHERE slots > 0),
step AS (SELECT n, min(g) AS g FROM (SELECT DISTINCT n FROM b), range(greatest(1, round(n * (sqrt(5) - 1) / 2)::BIGINT), n + 2) AS r(g) WHERE gcd(g, n) = 1 GROUP BY n),
points AS (SELECT slot, (slot * g) % step.n AS point FROM step, range(step.n) AS r(slot)),
ranked AS (SELECT b.*, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank FROM points JOIN b ON point >= until - slots AND point < until),
cuts AS (SELECT source, slot, rank % per_use AS block,
                CASE WHEN rank = slots - 1 AND whole % source_size > 0 THEN whole % source_size - (rank % per_use) * {words}
                     ELSE least({words}, source_size - (rank % per_use) * {words}) END AS words FROM ranked),
pieces AS (SELECT row, source, start, size, unnest(range(start // {words}, (start + size - 1) // {words} + 1)) AS block FROM p WHERE size > 0),
met AS (SELECT row, slot, least(start + size, e.block * {words} + words) - greatest(start, e.block * {words}) AS used
        FROM pieces e JOIN cuts c ON e.source IS NOT DISTINCT FROM c.source AND e.block = c.block),
told AS (SELECT row, sum(used)::BIGINT AS taken, min(slot)::BIGINT AS first_slot, count(*) AS slots FROM met WHERE used > 0 GROUP BY row)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot, coalesce(slots, 0)::BIGINT AS slots FROM p LEFT JOIN told USING (row)
""".replace("{words}", "512")


_SQL_SEARCH = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}') AS terms FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{term}')) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d),
f AS MATERIALIZED (SELECT row, doc_id, len(terms)::BIGINT AS n, term, count(*) AS tf FROM (SELECT row, doc_id, terms, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM f, s GROUP BY term, n_docs),
r AS (SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN f USING (term), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0 QUALIFY rank <= 50
""".replace("{term}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _crc32_sql(value: str) -> str:
    """CRC-32 of a string's UTF-8 bytes, as a BIGINT."""
    return f"""xor(4294967295::BIGINT, list_reduce(
      list_transform(range(length(hex(encode({value})))), lambda i: (instr('0123456789ABCDEF', substr(hex(encode({value})), i + 2 - 2 * (i % 2), 1)) - 1)::BIGINT),
      lambda c, d: xor(c >> 4, [{", ".join(f"{_crc_nibble(n)}::BIGINT" for n in range(16))}][1 + (xor(c, d) & 15)]), 4294967295::BIGINT))"""


def _edit_sql(state: str, cost: str, initial: str, row: str | None) -> str:
    """A way (cost in six digits, initials, chr(1), repaired rows) with one more edit; `z` is no way."""
    cut = f"instr({state}, chr(1))"
    more = f" || CASE WHEN {cut} = length({state}) THEN '' ELSE chr(10) END || {row}" if row else ""
    return f"CASE WHEN {state} = 'z' THEN 'z' ELSE lpad((substr({state}, 1, 6)::INTEGER + {cost})::VARCHAR, 6, '0') || substr({state}, 7, {cut} - 7) || '{initial}' || substr({state}, {cut}){more} END"


def _conversations_sql() -> str:
    """The least way to each state (nothing yet, after s, u, a), row by row, then the least that may end."""
    keep = lambda state, role: f"CASE WHEN e[2] <> 'd' AND e[1] = '{role}' THEN {_edit_sql(state, extra, 'K', said)} ELSE 'z' END"
    fill = lambda state, role: f"CASE WHEN e[2] <> 'd' THEN {_edit_sql(state, f'3 + {extra}', 'R', f"'{role}:' || e[4]")} ELSE 'z' END"
    extra, said, to = "CASE WHEN e[2] = 't' THEN 3 ELSE 0 END", "e[3] || ':' || e[4]", [_edit_sql(f"a[{i}]", "4", "D", None) for i in range(1, 5)]
    least = lambda *ways: f"least({', '.join(ways)})"
    step = [
        to[0],
        least(to[1], keep("a[1]", "s")),
        least(to[2], *[keep(f"a[{i}]", "u") for i in (1, 2, 4)], *[fill(f"a[{i}]", "user") for i in (1, 2, 4)]),
        least(to[3], keep("a[3]", "a"), fill("a[3]", "assistant")),
    ]
    user, assistant = (lambda x: _edit_sql(x, "3", "I", "'user:'")), (lambda x: _edit_sql(x, "3", "I", "'assistant:'"))
    filled = lambda x: f"list_transform([{x}], lambda b: [b[1], b[2], least(b[3], {user('b[1]')}, {user('b[2]')}, {user('b[4]')}), b[4]])[1]"
    closed = lambda x: f"list_transform([{filled(x)}], lambda g: [g[1], g[2], g[3], least(g[4], {assistant('g[3]')})])[1]"
    start = closed("['000000' || chr(1), 'z', 'z', 'z']")
    space, white = (lambda c: f"coalesce({c}::VARCHAR, ' ')"), r"\x20\x09-\x0D"
    pair = "substr(lag(role) OVER o, 1, 1) || substr(role, 1, 1)"
    return f"""
WITH h AS (SELECT conv_id, turn, {space("role")} AS role, {space("text")} AS text, {_crc32_sql(f"{space('conv_id')} || ':' || {space('turn')}")} % 20 AS harm FROM conversations),
d AS (SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role, CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS time FROM h WHERE harm <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS seen, regexp_extract(text, '[^{white}](?:[{white}]*)$')[1] AS last FROM d),
f AS (SELECT *, CASE WHEN last = '' OR NOT regexp_matches(text, '[^{white}]') THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(role) OVER o IS NOT NULL AND {pair} NOT IN ('su', 'ua', 'au') AS illegal
      FROM n WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), seen)),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal,
        list([substr(role, 1, 1), CASE fault WHEN '' THEN 'c' WHEN 'truncated' THEN 't' ELSE 'd' END, role, text] ORDER BY turn NULLS FIRST, role, sha256(text), seen) AS rows FROM f GROUP BY conv_id),
w AS (SELECT *, list_reduce(rows, lambda a, e: {closed(f"[{', '.join(step)}]")}, {start}) AS ways FROM g),
b AS (SELECT *, least(ways[1], ways[4]) AS way FROM w)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(substr(way, 1, 6)::BIGINT, 0) AS cost, coalesce(substr(way, 7, instr(way, chr(1)) - 7), '') AS audit,
  sha256(coalesce(substr(way, instr(way, chr(1)) + 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op9_sharding": _SQL_SHARDING, "op10_mixing": _SQL_MIXING, "op11_search": _SQL_SEARCH, "op13_conversations": _conversations_sql()}
