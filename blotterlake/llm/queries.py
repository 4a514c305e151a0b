"""One query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotterlake.llm import oracles
from blotterlake.llm.common import materialize, prepare, scratch_path, table
from blotterlake.llm.tokens import default_tokenizer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {
    "op11_vector_codes": oracles.vector_codes(),
    "op12_spelling_variants": oracles.spelling_variants(),
    "op13_line_dedup": oracles.line_dedup(),
}


def query(name: str):
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


@query("op1_packing")
def packing(spark, sf_dir):
    from blotterlake.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())


@query("op9_token_records")
def token_records(spark, sf_dir):
    from blotterlake.llm.records import token_records

    path = scratch_path(spark, "token-records")
    index = token_records(table(spark, sf_dir, "documents"), path, default_tokenizer())
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


@query("op7_mixing")
def mixing(spark, sf_dir):
    from blotterlake.llm.mixing import taken

    mixed = taken(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op8_fingerprints")
def fingerprints(spark, sf_dir):
    from blotterlake.llm.syncmers import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def simhash(spark, sf_dir):
    from blotterlake.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query("op6_language_id")
def language_id(spark, sf_dir):
    from blotterlake.llm.langid import fit, identify, training_rows

    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(training_rows(docs)))


@query("op4_lm_scores")
def lm_scores(spark, sf_dir):
    from blotterlake.llm.lm import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


@query("op10_nearest")
def nearest(spark, sf_dir):
    from blotterlake.llm.hnsw import nearest, query_rows, usable

    rows = materialize(usable(table(spark, sf_dir, "embeddings")), "vectors")
    return nearest(rows, query_rows(rows))


@query("op2_url_filter")
def url_filter(spark, sf_dir):
    from blotterlake.llm.url_filter import judge

    return judge(table(spark, sf_dir, "pages"))


@query("op3_suffix_dedup")
def suffix_dedup(spark, sf_dir):
    from blotterlake.llm.suffix_dedup import repeat_report

    return repeat_report(table(spark, sf_dir, "documents"))


@query("op11_vector_codes")
def vector_codes(spark, sf_dir):
    from blotterlake.llm.vector_codes import code_report

    return code_report(table(spark, sf_dir, "embeddings"))


@query("op12_spelling_variants")
def spelling_variants(spark, sf_dir):
    from blotterlake.llm.variants import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


@query("op13_line_dedup")
def line_dedup(spark, sf_dir):
    from blotterlake.llm.line_dedup import line_report

    return line_report(table(spark, sf_dir, "documents"))
