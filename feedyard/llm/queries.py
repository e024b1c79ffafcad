"""The registered queries: thin applications of the operators to the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedyard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


_OP1 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, row_number() OVER w AS k,
    CASE WHEN lag(role) OVER w = role THEN 0 ELSE 1 END AS first,
    length(regexp_replace(regexp_replace(text,
      '<(\\*(?:\|\w+\|>|/?s>|</?SYS>>))', '<\\\1', 'g'),
      '\[(\\*/?INST\])', '[\\\1', 'g')) AS escaped
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(escaped + CASE WHEN first = 1 THEN 12 + length(role) + 1 + 11 ELSE 11 END)::BIGINT AS formatted_chars,
  sum(first)::BIGINT AS n_blocks
FROM marked GROUP BY conv_id
"""


@query("op1_chat_format", _OP1)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm import chat

    said = "</s>[INST] ok [/INST]"
    probe = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(said).alias("text"))
        for k, role in enumerate(("user", "assistant"))
    ])).alias("r")).select("r.*")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    formed = chat.format_chats(turns)
    back = formed.select(
        "conv_id", "n_blocks", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"),
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_blocks").cast("long").alias("n_blocks"),
    )


_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

_OP3 = r"""
WITH u AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r(rule, rhost, rpath, said) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
), hit AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
  FROM (SELECT row_number() OVER () AS k, * FROM u) u
  LEFT JOIN r ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath)
  GROUP BY k, page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(said, 'allow') AS verdict FROM hit
"""


@query("op3_url_filter", _OP3)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.url_rules import judge_urls

    rules = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in _RULES
    ])).alias("r")).select("r.*")
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules, "page_id", "url")


@query("op4_shard")
def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.sharding import shard_rows

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the texts travel to their shards, and are summed there
    return shard_rows(docs, "doc_id", "text", n_shards=40, row_cost=16, carry=("text",)).select(
        "doc_id", "size", F.crc32("carried.text").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_bpe")
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from feedyard.llm.bpe import encode_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), digest=True)


_OP6 = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))) IS NOT false
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 5
"""


@query("op6_topk", _OP6)
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.topk import exact_topk, quantised

    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", scale=256)
    queries = vectors.where(F.pmod(F.col("id"), F.lit(50)) == 0)
    return exact_topk(queries, vectors, k=5).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score",
    )


_OP7 = r"""
WITH lines AS (
  SELECT doc_id, source, pos, trim(line, ' ') AS line
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents)
), boiler AS (
  SELECT line, min((doc_id, pos)) AS keep FROM lines
  WHERE length(line) - length(replace(line, ' ', '')) >= 2
  GROUP BY line HAVING count(DISTINCT source) >= 8
), gone AS (
  SELECT doc_id, list(pos) AS gone FROM lines JOIN boiler USING (line)
  WHERE (doc_id, pos) <> keep GROUP BY doc_id
), made AS (
  SELECT doc_id, coalesce(gone, []) AS gone,
    array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10)) AS text
  FROM documents LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, len(gone)::BIGINT AS n_removed, length(text)::BIGINT AS n_chars, sha256(text) AS text_sha256 FROM made
"""


@query("op7_line_dedup", _OP7)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.line_dedup import remove_boilerplate

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return remove_boilerplate(docs, "doc_id", "text", "source").select(
        "doc_id",
        F.size("lines_removed").cast("long").alias("n_removed"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )


_OP8_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP8 = rf"""
WITH d AS (SELECT doc_id, {_OP8_WORDS.format('text')} AS w FROM documents),
b AS (SELECT item_id, {_OP8_WORDS.format('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
places AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT d.doc_id, d.w, s.n, unnest(range(1, len(d.w) - s.n + 2)) AS i FROM d JOIN sizes s ON len(d.w) >= s.n)
),
hits AS (SELECT doc_id, places.n, i, item_id FROM places JOIN win USING (n, win)),
per AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY doc_id
),
words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN words USING (doc_id)
"""


@query("op8_decontaminate", _OP8)
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.decontaminate import find_windows

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find_windows(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def held_out(doc_id: str = "doc_id"):
    """The fold never learned from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


@query("op10_language")
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.language import detect

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return detect(docs, "doc_id", "text", "lang", may_train=~held_out()).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score",
    )


@query("op9_ngram_join")
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.ngram_join import similar_groups

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar_groups(docs, "doc_id", "text")[0]


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.pii import KINDS, find_personal_data

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(told("base"), 256).alias("base_sha256"), told("spans").alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"),
    )


_OP11 = r"""
WITH RECURSIVE given AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, c - c % 20 AS donor, xor(4294967295, list_reduce(
      list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END),
      4294967295::BIGINT)) % 4 AS h
  FROM (SELECT DISTINCT c FROM given)
), built AS (
  SELECT k.c, role, text, row_number() OVER (PARTITION BY k.c ORDER BY part, i) AS d FROM (
    SELECT convs.c, 0 AS part, i, role, text FROM convs JOIN given ON given.c = donor AND i <= h
    UNION ALL SELECT c, 1, i, role, text FROM given JOIN convs USING (c) WHERE i > h) k
), walk AS (
  SELECT c, 0::BIGINT AS d, '' AS k, NULL::VARCHAR AS p, 0::BIGINT AS words FROM convs
  UNION ALL
  SELECT b.c, b.d, md5(concat(w.k, '|', length(role), ':', role, text)), w.k,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))
  FROM walk w JOIN built b ON b.c = w.c AND b.d = w.d + 1
), ends AS (
  SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends
  FROM (SELECT c, arg_max(k, d) AS k FROM walk GROUP BY c) GROUP BY k
), nodes AS (
  SELECT k, any_value(p) AS p, any_value(d) AS d, min(c) AS c, count(*) AS n, any_value(words) AS words FROM walk GROUP BY k
), kids AS (
  SELECT p AS k, count(*) AS n_children FROM nodes WHERE p IS NOT NULL GROUP BY p
), own AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n - 1) * words AS saved FROM nodes LEFT JOIN kids USING (k)
), sums AS (
  SELECT a.k, count(*) FILTER (own.n_children = 0) AS n_leaves, sum(own.saved)::BIGINT AS saved
  FROM own JOIN walk a ON a.c = own.c AND a.d <= own.d GROUP BY a.k
)
SELECT own.c AS conv_id, own.d AS depth, up.c AS parent_conv_id, own.n AS n_convs, own.n_children, n_leaves,
  sums.saved AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM own JOIN sums USING (k) LEFT JOIN ends USING (k) LEFT JOIN nodes up ON up.k = own.p
"""


@query("op11_prefix_trie", _OP11)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.prefix_trie import prefix_trie

    c = F.col("c")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(turns, "conv_id", "turn", "role", "text",
                       head=F.crc32(c.cast("string")) % 4, donor=c - c % 20, most_head=3)


@query("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from feedyard.llm.token_counts import count_tokens

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, "doc_id", "text", public_tokenizers.path("piece_bpe_32k.model")).withColumn(
        "over_limit", F.col("n_tokens") > 4096)


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedyard.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
