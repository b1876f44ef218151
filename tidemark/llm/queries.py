"""The registered queries of this subpackage and, where SQL can state them, the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ann, exact, html_text, language_id, mixing, packing, prefix_trie, quality, repeats, secrets
from tidemark.llm import simhash, toxicity, turn_repair
from tidemark.llm.common import remainder, table
from tidemark.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer's vocabulary file lies on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def register(name: str, oracle: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return build

    return add


@register("op1_nearest")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op2_repeats")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register("op3_main_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@register("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    # The digest of a candidate, not the candidate: results are read more widely than texts.
    return found.select(
        "doc_id", "start", F.length("candidate").cast("bigint").alias("length"),
        F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret",
    )


@register("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@register("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out), "doc_id", "text", "toxic")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@register(
    "op8_exact_dedup",
    r"""
    WITH digests AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
    FROM digests WINDOW same AS (PARTITION BY text_sha256)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.settle(table(spark, sf_dir, "documents"))


@register(
    "op9_mix_sources",
    r"""
    WITH sized AS (
        SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
        FROM documents
    ), per_source AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
    ), ranked AS (
        SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM per_source
    ), weighed AS (
        SELECT *, [5, 2, 1][(place - 1) % 3 + 1] AS weight FROM ranked
    ), level AS (
        SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
                       ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                  / sum(weight) OVER (ORDER BY source_size / weight, place
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM weighed
    ), shares AS (
        SELECT *, least((max(CASE WHEN level * weight <= 3 * source_size THEN level END) OVER ()) * weight,
                        CAST(3 * source_size AS DOUBLE)) AS target
        FROM level
    ), queue AS (
        SELECT d.doc_id, d.k, d.size, s.place, s.source_size, s.weight, s.target,
               sum(d.size) OVER (PARTITION BY s.place ORDER BY d.k, d.size, d.doc_id) AS upto
        FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
    ), served AS (
        SELECT *, (r * source_size + upto) / weight AS finish FROM queue, range(3) t(r)
    ), spent AS (
        SELECT *, sum(size) OVER (ORDER BY finish, place, r, k, size, doc_id ROWS UNBOUNDED PRECEDING) AS spent FROM served
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(sum(CASE WHEN spent <= (SELECT sum(source_size) FROM per_source) THEN size ELSE 0 END) AS BIGINT) AS taken
    FROM spent GROUP BY doc_id, size, source_size, target, place, k
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@register("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out), "doc_id", "text", "quality")
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register(
    "op11_prefix_trie",
    r"""
    WITH ordered AS (
        SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS place
        FROM conversations WHERE conv_id IS NOT NULL
    ), listed AS (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY place) AS turns,
               -- crc32 of the id's decimal digits, bit by bit, from the reversed polynomial 0xEDB88320.
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
                   string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce(
                       [xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))),
                   4294967295) % 9 AS h
        FROM ordered GROUP BY conv_id
    ), rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
        FROM listed c LEFT JOIN listed b ON b.conv_id = c.conv_id - c.conv_id % 5
    ), prefixes AS (
        SELECT conv_id, d AS depth, len(turns) = d AS last, strlen(turns[d].text) AS bytes,
               sha256(CAST(to_json(turns[1:d]) AS VARCHAR)) AS k, sha256(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) AS parent_k
        FROM rebuilt, unnest(range(0, len(turns) + 1)) t(d)
    ), nodes AS (
        SELECT k, depth, any_value(parent_k) AS parent_k, min(conv_id) AS conv_id, count(*) AS n_convs,
               coalesce(any_value(bytes), 0) * (count(*) - 1) AS saved,
               sha256(coalesce(string_agg(CASE WHEN last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), ''))
                 AS ends_sha256
        FROM prefixes GROUP BY k, depth
    ), children AS (
        SELECT parent_k AS k, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
    ), counted AS (
        SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (k, depth)
    ), above AS (
        -- A node's smallest member passes through all its ancestors.
        SELECT a.k, a.depth, sum(CASE WHEN n.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(n.saved) AS saved_tokens
        FROM counted n JOIN prefixes a ON a.conv_id = n.conv_id AND a.depth <= n.depth GROUP BY a.k, a.depth
    )
    SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
           CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM counted n JOIN above a USING (k, depth) LEFT JOIN nodes p ON p.k = n.parent_k AND p.depth = n.depth - 1
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    conv = F.col("conv_id")
    return prefix_trie.trie(*prefix_trie.grafted(turns, remainder(conv, 9), conv - conv % 5, most=8))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in by a hash of conversation and turn: some lost, emptied, cut, repeated or misnamed."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    return conversations.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(space("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


@register("op12_turn_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.report(damaged(conversations), conversations.select("conv_id"))


@register("op13_language")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
