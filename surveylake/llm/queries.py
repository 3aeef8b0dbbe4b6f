"""The numbered operators applied to the whole tables they are meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm import (
    bag_minhash, chaining, cross_parsing, masked_lm, mixing, packing, pii, prefix_trie, segment_bpe, structure_repair, url_templates, va_file, weak_supervision,
)
from surveylake.llm.common import saved

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
# Parts of texts a worker of op1 remembers.
REMEMBERED_PARTS = 1_500_000

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), tokenizer_path(), remembered=REMEMBERED_PARTS)
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim).placed


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = masked_lm.coded(docs)
    return masked_lm.scored_words(docs, masked_lm.fit(docs, chunks=chunks), chunks=chunks).drop("text")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every vector whose id is divisible by 50."""
    return va_file.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.detect(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str) -> Column:
        number = F.size(F.filter("pii_base", lambda s: s["kind"] == pii.KINDS.index(kind)))
        return number.cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, ("email", "ip", "card", "phone")),
        F.sha2(pii.listed(F.col("pii_base")), 256).alias("base_sha256"),
        pii.listed(F.col("pii_spans")).alias("spans"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents mixed to source weights that flatten their row counts."""
    return mixing.mixed(_table(spark, sf_dir, "documents"))


# The rules on urls.
URL_RULES = (
    url_templates.Rule("allow", "org", "/"),
    url_templates.Rule("block", "example.org", "/es/"),
    url_templates.Rule("block", "example.org", "/en/1"),
    url_templates.Rule("allow", "com", "/fr/"),
    url_templates.Rule("block", "com", "/de/"),
)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return url_templates.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and whether it is kept."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = saved(weak_supervision.measured(docs).drop("text"), "quality-statistics")
    rules = weak_supervision.default_rules()
    failed = weak_supervision.base_failed()
    good = weak_supervision.posterior(rules, weak_supervision.fit(found.where(~failed), rules))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (good >= weak_supervision.KEPT)).alias("kept"), good.alias("quality"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: class id (its smallest doc_id) and whether the document stays."""
    return bag_minhash.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "keep")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that repeat across documents."""
    return chaining.passages(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = _table(spark, sf_dir, "documents")
    unseen = cross_parsing.held_out()
    model = cross_parsing.fit(docs, F.col("doc_id").isNotNull() & ~unseen)
    found = cross_parsing.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", unseen.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie over all conversations, each begun with up to five turns of its hundred's first one."""
    conv_id = F.col("conv_id")
    own = prefix_trie.turns(_table(spark, sf_dir, "conversations"))
    shared = F.crc32(conv_id.cast("string")) % 6
    return prefix_trie.trie(*prefix_trie.restarted(own, shared, conv_id - conv_id % 100, most=5))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and a digest of the repaired turns of every conversation after damage."""
    conversations = _table(spark, sf_dir, "conversations")
    return structure_repair.report(conversations, structure_repair.damaged(conversations))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and of the bytes decoded from them."""
    import public_tokenizers

    path = tokenizer_path(RANKS)
    ids = segment_bpe.encode(F.col("text"), path, public_tokenizers.PATTERN)
    return _table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(segment_bpe.decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_pii": op4_pii,
    "op5_mixing": op5_mixing,
    "op6_url_filters": op6_url_filters,
    "op7_quality_rules": op7_quality_rules,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_language_id": op10_language_id,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_structure_repair": op12_structure_repair,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLES: dict[str, str] = {
    "op3_exact_top_k": va_file.TOP_K_SQL,
    "op5_mixing": mixing.mixed_sql(),
    "op11_conversation_prefix_trie": prefix_trie.TRIE_SQL,
}
