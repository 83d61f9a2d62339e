"""The operators over their whole tables, with production parameters, and SQL where it can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontamination, divergence, extraction, licenses, neardup, pieces, repair, sharding, substrings, toxicity, vectors
from .common import map_arrow

#: Fixed rows that the chat query adds to its table.
CONTROL_ROWS = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
SHARDS = [f"shard-{k:03d}" for k in range(64)]
ALPHABETS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rank_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def model_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of every conversation as read back from its formatted text."""
    given = table(spark, sf, "conversations").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    control = spark.createDataFrame(CONTROL_ROWS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_turns(given.unionByName(control))

    def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                turns = chat.parse(text)
                loss = "".join(chat.unescape(text[s["start"] : s["end"]]) for s in spans)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                out[0].append(len(turns))
                out[1].append(hashlib.sha256(whole.encode()).hexdigest())
                out[2].append(len(loss))
                out[3].append(hashlib.sha256(loss.encode()).hexdigest())
                out[4].append(len(text))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], names=names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return map_arrow(formatted.select("conv_id", "formatted", "loss_spans"), read_back, schema)


def op2_license(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf, "documents"), ["doc_id"]), ["doc_id"])


def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_digest(table(spark, sf, "documents"), rank_file())


def bpe_digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Every text encoded, and its ids decoded again."""
    coded = bpe.encode(docs, ["doc_id"], "text", vocabulary, decoded=True)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = extraction.extract(table(spark, sf, "pages"), ["page_id", "url"])
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, ["doc_id"], toxicity.train(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"])
    return found.select("doc_id", "n_words", decontamination.n_hit().alias("n_hit"), "item_ids").select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("item_ids"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.place(table(spark, sf, "documents").select("doc_id"), "doc_id", SHARDS).select("doc_id", "slot", "shard")


def op8_neardup(spark: SparkSession, sf: str) -> DataFrame:
    found = neardup.classes(table(spark, sf, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op9_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.link_vectors(table(spark, sf, "embeddings"), exact=False)


def op10_substrings(spark: SparkSession, sf: str) -> DataFrame:
    left = substrings.remove_repeats(table(spark, sf, "documents"), ["doc_id"])
    line = F.trim(F.regexp_replace(F.coalesce("kept", F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return left.select("doc_id", "n_words", "n_removed", F.sha2(line, 256).alias("kept_sha256"))


def damaged(turns: DataFrame) -> DataFrame:
    """The conversations table with planted faults, by a checksum of conversation and turn; nulls are one space in texts."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    case = F.crc32(F.concat(said[0], F.lit(":"), said[1])) % 20
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(said[3], "[.!?]", "")).otherwise(said[3])
    copies = F.when(case == 0, 0).when(case == 3, 2).otherwise(1)
    rows = turns.select("conv_id", "turn", F.when(case == 4, "user").otherwise(said[2]).alias("role"), text.alias("text"), copies.alias("copies"))
    return rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def op11_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired turns of every conversation after the damage."""
    given = table(spark, sf, "conversations")
    found = repair.repair(damaged(given))
    line = F.concat("role", F.lit(":"), "text").alias("line")
    left = found.turns.filter("edit <> 'D'").select("key", "block", "seq", line)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One hash a conversation, taken as its lines come by."""
        key, whole = None, None
        for batch in batches:
            done = []
            for own, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if own != key:
                    if whole:
                        done.append((key, whole.hexdigest()))
                    key, whole = own, hashlib.sha256(said.encode())
                else:
                    whole.update(b"\n" + said.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["key", "repaired_sha256"])
        if whole:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([whole.hexdigest()])], names=["key", "repaired_sha256"])

    sorted_ = left.repartition("key").sortWithinPartitions("key", "block", "seq").select("key", "line")
    hashed = map_arrow(sorted_, digests, "key string, repaired_sha256 string")
    each = given.select(F.col("conv_id"), repair.conversation_key(F.col("conv_id")).alias("key")).distinct()
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return each.join(found.conversations, "key", "left").join(hashed, "key", "left").select(
        "conv_id", *sums, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def op12_pieces(spark: SparkSession, sf: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf, "documents"), ["doc_id"], "text", model_file(), decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


QUERIES = {
    "op1_chat": op1_chat,
    "op2_license": op2_license,
    "op3_bpe": op3_bpe,
    "op4_extraction": op4_extraction,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_neardup": op8_neardup,
    "op9_vectors": op9_vectors,
    "op10_substrings": op10_substrings,
    "op11_repair": op11_repair,
    "op12_pieces": op12_pieces,
    "op13_divergence": op13_divergence,
}


def _chat_sql() -> str:
    heads = " ".join(f"WHEN '{role}' THEN {len(f'### {name}: ')}" for role, name in chat.ROLES.items())
    rows = ", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in CONTROL_ROWS)
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES {rows}) v(conv_id, turn, role, text))
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum((CASE role {heads} ELSE length(url_encode(role)) + {len("### @: ")} END) + length(text) + {len(chat.END)}
           + len(regexp_extract_all(text, '### (?:{"|".join(chat.ROLES.values())}|@[A-Za-z0-9_.~%/-]*): |</turn>')))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""


def _license_sql() -> str:
    table_ = [*licenses.rules(), *licenses.base_rules()]
    first_base = len(licenses.rules())
    rows = ", ".join(f"({n}, {p}, '{label}', '{word}', '{licenses.on_padded(pattern)}')" for n, p, label, word, pattern in table_)
    score = " ".join(f"WHEN {p} THEN {c}::DOUBLE" for p, c in licenses.CONFIDENCE.items())
    longer = " OR ".join(f"(priority >= {p} AND stop <= coalesce(reach{p}, -1))" for p in licenses.CONFIDENCE)
    reaches = ", ".join(
        f"max(CASE WHEN priority = {p} THEN stop END) OVER (PARTITION BY r ORDER BY start, stop DESC, priority, rule "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach{p}"
        for p in licenses.CONFIDENCE
    )
    return rf"""
WITH rules(rule, priority, label, keyword, pattern) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), '{WORDS}') AS w FROM documents),
p AS (SELECT r, doc_id, len(w) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS line, w FROM d),
c AS (SELECT r, line, rules.* FROM (SELECT r, line, unnest(list_distinct(w)) AS keyword FROM p) JOIN rules USING (keyword)),
m AS (SELECT r, rule, priority, label, regexp_extract_all(line, pattern) AS found, string_split_regex(line, pattern) AS pieces
      FROM c WHERE regexp_matches(line, pattern)),
f AS (SELECT r, rule, priority, label, k,
             list_sum(list_transform(pieces[1:k], lambda x: (length(x) - length(replace(x, ' ', ''))) // 2))
             + coalesce(list_sum(list_transform(found[1:k - 1], lambda x: (length(x) - length(replace(x, ' ', ''))) // 2)), 0) AS start,
             (length(found[k]) - length(replace(found[k], ' ', ''))) // 2 AS n
      FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM m)),
s AS (SELECT r, rule, priority, label, start::BIGINT AS start, (start + n)::BIGINT AS stop FROM f),
o AS (SELECT *, {reaches} FROM s),
kept AS (SELECT * FROM o WHERE NOT ({longer})),
base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word FROM s WHERE rule >= {first_base} GROUP BY r),
names AS (SELECT r, label, true AS based FROM s WHERE rule >= {first_base} UNION ALL SELECT r, label, false FROM kept),
labels AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (based) AS base_labels,
                  string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM names GROUP BY r),
best AS (SELECT r, min(priority) AS priority FROM kept GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(CASE best.priority {score} END, 0::DOUBLE) AS score
FROM p LEFT JOIN base USING (r) LEFT JOIN labels USING (r) LEFT JOIN best USING (r)"""


_DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), '{WORDS}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), '{WORDS}') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), {decontamination.WINDOW}) AS n, array_to_string(w[p:p + least(len(w), {decontamination.WINDOW}) - 1], ' ') AS s
       FROM (SELECT *, unnest(range(1, greatest(len(w) - {decontamination.WINDOW} + 2, 2))) AS p FROM i WHERE len(w) > 0)),
dw AS (SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw))),
h AS (SELECT r, p, n, item_id FROM dw JOIN iw USING (n, s)),
words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS pos FROM h) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


_SUBSTRINGS_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, p, md5(array_to_string(w[p:p + {substrings.WINDOW - 1}], ' ')) AS h
      FROM (SELECT r, w, unnest(range(1, len(w) - {substrings.WINDOW - 2})) AS p FROM d)),
again AS (SELECT h FROM s GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, list_sort(list_distinct(flatten(list(range(p, p + {substrings.WINDOW}))))) AS gone FROM s JOIN again USING (h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda k: NOT list_contains(gone, k)), lambda k: w[k]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN hit USING (r)"""


_VECTORS_SQL = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
g AS (SELECT r, vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
      WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
l AS (SELECT a.r AS a, b.r AS b, a.vec_id AS ida, b.vec_id AS idb FROM g a JOIN g b ON a.r <> b.r AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= {vectors.SIMILARITY}),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY reach.a),
n AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN c USING (r) LEFT JOIN n USING (r)"""


def _repair_sql() -> str:
    table_ = []
    for value in range(256):  # of the checksum
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table_.append(str(value))
    return rf"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce('=' || conv_id::VARCHAR, '') AS key,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS h
    FROM conversations, (SELECT [{", ".join(table_)}]::BIGINT[] AS tab)),
x AS (SELECT key, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END)
      FROM o WHERE h <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY key, role, text ORDER BY p) > 1 AS again
      FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS p FROM x)),
f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                     WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS kind,
             lag(left(role, 1)) OVER (PARTITION BY key ORDER BY p) AS before FROM r),
go(q, k, n) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
names(k, name) AS (VALUES ('u', 'user'), ('a', 'assistant')),
ins(q, n, edits, cost, said) AS (SELECT q, q, '', 0, '' FROM (SELECT DISTINCT q FROM go)
    UNION ALL SELECT ins.q, go.n, edits || 'I', cost + 2, said || name || ':' || chr(10) FROM ins JOIN go ON go.q = ins.n JOIN names USING (k) WHERE cost < 6),
dp(key, p, q, best) AS (SELECT DISTINCT key, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'said': ''}} FROM f
    UNION ALL SELECT dp.key, f.p, coalesce(go.n, ins.n), min({{'cost': best.cost + ins.cost + CASE e WHEN 'D' THEN 3 ELSE CASE e WHEN 'R' THEN 2 ELSE 0 END + (fault = 'truncated')::INT END,
              'audit': best.audit || edits || e, 'said': best.said || ins.said || CASE e WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10) ELSE name || ':' || text || chr(10) END}})
    FROM dp JOIN f ON f.key = dp.key AND f.p = dp.p + 1 JOIN ins ON ins.q = dp.q CROSS JOIN (VALUES ('D'), ('K'), ('R')) v(e)
    LEFT JOIN go ON go.q = ins.n AND ((e = 'K' AND go.k = kind) OR (e = 'R' AND go.k <> 's')) LEFT JOIN names ON names.k = go.k
    WHERE e = 'D' OR (go.n IS NOT NULL AND fault NOT IN ('blank', 'duplicate')) GROUP BY dp.key, f.p, coalesce(go.n, ins.n)),
fin AS (SELECT key, min({{'cost': best.cost + ins.cost, 'audit': best.audit || edits, 'said': best.said || ins.said}}) AS best
        FROM dp JOIN (SELECT key, max(p) AS p FROM f GROUP BY key) USING (key, p) JOIN ins USING (q) WHERE n IN (0, 3) GROUP BY key),
s AS (SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
             count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (before IS NOT NULL AND before || kind NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY key)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
       sha256(coalesce(left(best.said, -1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM o) LEFT JOIN s USING (key) LEFT JOIN fin USING (key)"""


_DIVERGENCE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), {ALPHABETS}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {divergence.DOCUMENTS}),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM t JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(n, 0) AS n, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL) USING (lang, source)
      LEFT JOIN (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY ALL) USING (lang)),
p AS (SELECT g.lang, g.source, kept.term, 1 + {divergence.SCALE}::HUGEINT * (coalesce(c, 0) + 1) // (n + v) AS p, coalesce(c, 0) AS c
      FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + {divergence.SCALE}::HUGEINT * (sum(c) + 1) // (any_value(n) + any_value(v)) AS q
      FROM c JOIN (SELECT lang, sum(n)::HUGEINT AS n, any_value(v) AS v FROM g GROUP BY lang) USING (lang) GROUP BY lang, term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
          UNION ALL SELECT a.lang, a.source, b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.v = 0),
told AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', item, value FROM told),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM ranked)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {divergence.TOP}"""


def _sharding_sql() -> str:
    slots = ",".join(map(str, sharding.fill_table(SHARDS)))
    return f"""
WITH t AS (SELECT string_split('{slots}', ',') AS shards),
s AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.TABLE_SIZE})::BIGINT AS slot FROM documents)
SELECT doc_id, slot, format('shard-{{:03d}}', shards[slot + 1]::INT) AS shard FROM s, t"""


SQL = {
    "op1_chat": _chat_sql(),
    "op2_license": _license_sql(),
    "op6_decontamination": _DECONTAMINATION_SQL,
    "op7_sharding": _sharding_sql(),
    "op9_vectors": _VECTORS_SQL,
    "op10_substrings": _SUBSTRINGS_SQL,
    "op11_repair": _repair_sql(),
    "op13_divergence": _DIVERGENCE_SQL,
}
