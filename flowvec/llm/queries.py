"""The registered corpus queries and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowvec.llm.best_fit_packing import packed_pieces
from flowvec.llm.block_names import exact_groups
from flowvec.llm.byte_backtrack import byte_digests
from flowvec.llm.common import wide_rows
from flowvec.llm.deobfuscation import find_personal
from flowvec.llm.divergence_rules import quality
from flowvec.llm.induced_dedup import remove_repeats
from flowvec.llm.recurrent_lm import score_documents
from flowvec.llm.retrieval_packing import retrieval_pack
from flowvec.llm.secret_links import find_secrets
from flowvec.llm.simplex_clusters import CLUSTERS, ROUNDS, cluster_report
from flowvec.llm.token_alignment import alignment_report
from flowvec.llm.trie_join import near_duplicates
from flowvec.llm.word_transducer import encode_documents


def documents(spark: SparkSession, folder: str) -> DataFrame:
    wide_rows(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def op1_block_names(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(documents(spark, folder))


OP1_SQL = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, sha256(norm) as text_sha256
from t window w as (partition by norm)"""

def op2_recurrent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(documents(spark, folder))


def op3_secret_links(spark: SparkSession, folder: str) -> DataFrame:
    return find_secrets(documents(spark, folder))


def op7_deobfuscation(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal(documents(spark, folder))


def op8_trie_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))


def op9_divergence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality(documents(spark, folder))


def op4_word_transducer(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(documents(spark, folder))


def op5_induced_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder))


def op6_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    return retrieval_pack(documents(spark, folder))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_pieces(documents(spark, folder))


def op11_simplex_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_report(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))


def _op11_sql() -> str:
    """The same rounds as chained tables, one row per vector and component."""
    steps = [
        """
with fine as (select vec_id, embedding from embeddings where len(embedding) = 64
  and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
cells as (select vec_id, unnest(range(64)) as i, cast(unnest(list_transform(embedding, lambda x: floor(256 * cast(x as double)))) as bigint) as x from fine),
seeds as (select vec_id, row_number() over (order by sha256('2:' || vec_id)) - 1 as c from fine qualify c < $clusters),
c0 as (select c, i, x from seeds join cells using (vec_id))"""
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"""
d{r} as (select vec_id, c, sum((cells.x - c{r}.x) * (cells.x - c{r}.x)) as d from cells join c{r} using (i) group by vec_id, c),
a{r} as (select vec_id, c, d from d{r} qualify row_number() over (partition by vec_id order by d, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} as (select c, i, sum(x) as s, count(*) as n from a{r} join cells using (vec_id) group by c, i),
c{r + 1} as (select c, i, case when n is null then c{r}.x else cast((s - ((s % n) + n) % n) // n as bigint) end as x
  from c{r} left join m{r} using (c, i))""")
    last = f"""
digests as (select c, sha256(string_agg(cast(x as varchar), ',' order by i)) as centroid_sha256 from c{ROUNDS} group by c)
select vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
       cast(sum(d) over () as bigint) as inertia, centroid_sha256
from a{ROUNDS} join digests using (c)"""
    return ",".join([*steps, last]).replace("$clusters", str(CLUSTERS))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment_report(documents(spark, folder))


def op13_byte_backtrack(spark: SparkSession, folder: str) -> DataFrame:
    return byte_digests(documents(spark, folder))


QUERIES = {
    "op1_block_names": op1_block_names,
    "op2_recurrent_lm": op2_recurrent_lm,
    "op3_secret_links": op3_secret_links,
    "op4_word_transducer": op4_word_transducer,
    "op5_induced_dedup": op5_induced_dedup,
    "op6_retrieval_packing": op6_retrieval_packing,
    "op7_deobfuscation": op7_deobfuscation,
    "op8_trie_join": op8_trie_join,
    "op9_divergence_rules": op9_divergence_rules,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_simplex_clusters": op11_simplex_clusters,
    "op12_token_alignment": op12_token_alignment,
    "op13_byte_backtrack": op13_byte_backtrack,
}
ORACLES = {
    "op1_block_names": OP1_SQL.strip(),
    "op11_simplex_clusters": _op11_sql().strip(),
}
