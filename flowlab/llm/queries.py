"""The dealt operators as queries over their whole tables.

Each query reads its table, applies the operator with production parameters
and keeps the columns of its contract. ``SQL`` holds equivalent DuckDB SQL
where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from flowlab.llm import alignment, bpe, bytebpe, chat, html, mil, mixing, ppm, prefixes, rules, simhash, tokencount, vectors
from flowlab.llm.common import table
from flowlab.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``fn(spark, sf_dir)``, with equivalent SQL if there is any."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_bpe")
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_rules", rules.sql())
def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op4_mil")
def op4_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned outside the held-out fold."""
    return mil.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix takes."""
    return mixing.taken(table(spark, sf_dir, "documents"))


@query("op2_ppm")
def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document, learned outside the held-out fold."""
    return ppm.score(table(spark, sf_dir, "documents"))


@query("op3_chat")
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations and of one full of control strings."""
    hard = "</s>[INST] ok [/INST]"
    extra = spark.sql(
        "select * from values (-7L, 0L, 'user', :hard), (-7L, 1L, 'assistant', :hard) as t(conv_id, turn, role, text)",
        args={"hard": hard},
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(rows.unionByName(extra))


@query("op8_vectors")
def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.range_join(table(spark, sf_dir, "embeddings"))


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, found by scanning flat token files."""
    return tokencount.count_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


@query("op9_html")
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.main_text(table(spark, sf_dir, "pages"))


@query("op13_bytebpe")
def op13_bytebpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as counts and digests."""
    import public_tokenizers

    return bytebpe.digests(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned groups and links of two tokenizers in every document."""
    import public_tokenizers

    return alignment.align_documents(
        table(spark, sf_dir, "documents"),
        tokenizer_file("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        tokenizer_file("piece_bpe_32k.model"),
        digest=True,
    )


@query("op11_prefixes", prefixes.SQL)
def op11_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations after their heads are shared."""
    return prefixes.trie_of_shared_heads(table(spark, sf_dir, "conversations"))
