"""Registered queries on chunks, tokens and embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowvec.functions import templates as TP
from flowvec.functions import vectors as V
from flowvec.operators import analytics as A
from flowvec.operators import ann
from flowvec.operators import bpe
from flowvec.operators import cooccurrence as CO
from flowvec.operators import embedding as M
from flowvec.operators import evaluation as E
from flowvec.operators import knn as K
from flowvec.operators import positions as P
from flowvec.operators import text as T
from flowvec.plans.registry import query
from flowvec.session import checkpoint
from flowvec.plans.rows import TOKEN_SQL
from flowvec.plans.search import scored, vectors
from flowvec.sources.tables import Tables

# --- chunks -----------------------------------------------------------------


def docs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "text")


@query("chunk_fixed_chars", """
select doc_id, i as chunk_no, substring(text, i * 300 + 1, 300) as chunk
from (select doc_id, text, unnest(generate_series(0, cast(ceil(length(text) / 300.0) as integer) - 1)) as i from documents)""")
def _(t: Tables) -> DataFrame:
    return T.char_chunks(docs(t), "text")


@query("chunk_words", r"""
select doc_id, i as chunk_no, array_to_string(w[i * 512 + 1 : i * 512 + 512], ' ') as chunk
from (select doc_id, w, unnest(generate_series(0, (len(w) - 1) // 512)) as i
      from (select doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as w from documents) where len(w) > 0)""")
def _(t: Tables) -> DataFrame:
    return T.word_chunks(docs(t), "text")


@query("chunk_paragraphs", r"""
with recursive ls as (select doc_id, string_split(text, chr(10)) as l from documents),
steps as (
  select doc_id, 0 as i, '' as cur, cast(null as varchar) as done from ls
  union all
  select s.doc_id, i + 1,
         case when length(cur) + length(l[i + 1]) < 500 then cur || l[i + 1] || chr(10) else l[i + 1] || chr(10) end,
         case when length(cur) + length(l[i + 1]) < 500 or cur = '' then null else cur end
  from steps s join ls on s.doc_id = ls.doc_id where i < len(l)),
chunks as (select doc_id, i, done as c from steps where done is not null union all
  select doc_id, 1000000000, arg_max(cur, i) from steps group by doc_id having arg_max(cur, i) <> '')
select doc_id, row_number() over (partition by doc_id order by i) - 1 as chunk_no,
       regexp_replace(regexp_replace(c, '^\s+', ''), '\s+$', '') as chunk from chunks""")
def _(t: Tables) -> DataFrame:
    return T.paragraph_chunks(docs(t), "text")


# --- tokens -----------------------------------------------------------------


def flow_texts(t: Tables, template: str = "comma5") -> DataFrame:
    return TP.serialize_flow(t.flow_texts, template).select("frame_number", "packet_text")


COMMA5 = """(select frame_number, ip_src || ', ' || ip_dst || ', ' || coalesce(cast(src_port as varchar), '') || ', '
  || coalesce(cast(dst_port as varchar), '') || ',  ' || protocol as x from $flows)"""


@query("tok_pretokenize", rf"""
select frame_number, i - 1 as i, toks[i] as token
from (select frame_number, toks, unnest(generate_series(1, len(toks))) as i from (
  select frame_number, list_filter(string_split_regex(regexp_replace(lower(x),
      '(\d+)\.(\d+)\.(\d+)\.(\d+)', '\1 . \2 . \3 . \4', 'g'), '[, ]+'), lambda q: q <> '') as toks from {COMMA5}))""")
def _(t: Tables) -> DataFrame:
    tokens = T.pretokenize(F.col("packet_text"))
    return flow_texts(t).select("frame_number", F.posexplode(tokens).alias("i", "token"))


def flow_pieces(t: Tables, template: str = "comma5") -> DataFrame:
    texts = flow_texts(t, template)
    return texts.select("frame_number", T.isolated_pieces(F.col("packet_text")).alias("tokens"))


@query("tok_bpe_train")
def _(t: Tables) -> DataFrame:
    """Merges until no pair repeats; symbols of the flow texts with the rank of their merge."""
    model, state = bpe.train(T.vocabulary(flow_pieces(t), "tokens"))
    ranked = t.spark.createDataFrame(
        [(a + b, i + 1) for i, (a, b) in enumerate(model.merges)], "symbol string, merge_rank int"
    ).groupBy("symbol").agg(F.min("merge_rank").alias("merge_rank"))
    used = state.select("n", F.explode("s").alias("symbol")).groupBy("symbol").agg(F.sum("n").alias("n"))
    # One row per merge: the vocabulary is the model itself.
    return used.join(F.broadcast(ranked), "symbol", "left")


# Given merges, and the characters beside which all others are unknown.
GIVEN_MERGES = [("1", "9"), ("19", "2"), ("1", "6"), ("16", "8"), ("0", "0"), ("1", "0"), ("2", "2"), ("T", "C"), ("TC", "P"), ("5", "3")]
GIVEN_CHARACTERS = "0123456789., TCPUD"


def _merge_steps(symbols: str) -> str:
    for a, b in GIVEN_MERGES:
        symbols = f"replace({symbols}, '<{a}><{b}>', '<{a}{b}>')"
    return symbols


@query("tok_bpe_encode", rf"""
with pieces as (select frame_number, unnest(regexp_extract_all(trim(x), '[,.\s]+|[^,.\s]+')) as piece,
         generate_subscripts(regexp_extract_all(trim(x), '[,.\s]+|[^,.\s]+'), 1) as p from {COMMA5}),
     marked as (select frame_number, p, {_merge_steps("regexp_replace(regexp_replace(piece, '[^0-9., TCPUD]', '?', 'g'), '(.)', '<\\1>', 'g')")} as m from pieces),
     body as (select frame_number, string_agg(replace(m, '<?>', '<[UNK]>'), '' order by p) as m from marked group by frame_number)
select frame_number, '[CLS] ' || replace(replace(replace(m, '><', '|'), '<', ''), '>', '') || ' [SEP]' as tokens,
       len(string_split(m, '><')) + 2 as n from body""")
def _(t: Tables) -> DataFrame:
    """Unseen texts by given merges, characters outside the alphabet unknown."""
    model = bpe.Merges(list(GIVEN_CHARACTERS), GIVEN_MERGES)
    made = bpe.encode(flow_pieces(t).withColumnRenamed("tokens", "pieces"), F.col("pieces"), model)
    inner = F.array_join(F.slice("tokens", 2, F.size("tokens") - 2), "|")
    return made.select("frame_number", F.concat(F.lit("[CLS] "), inner, F.lit(" [SEP]")).alias("tokens"), F.size("ids").cast("long").alias("n"))


WORDS = r"list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')"


@query("tok_pad_truncate", rf"""
select doc_id, array_to_string(w[1:128], ' ') || repeat(' [PAD]', greatest(128 - len(w), 0)) as tokens,
       least(len(w), 128) as real_tokens
from (select doc_id, {WORDS} as w from documents)""")
def _(t: Tables) -> DataFrame:
    padded, mask = T.pad_truncate(T.words(F.col("text")))
    return docs(t).select(
        "doc_id",
        F.array_join(padded, " ").alias("tokens"),
        F.aggregate(mask, F.lit(0), lambda a, x: a + x).alias("real_tokens"),
    )


HASH = "cast('0x' || substring(md5({}), 1, 7) as bigint)"


@query("prep_split", f"""
select frame_number, case when {HASH.format('cast(frame_number as varchar)')} % 10 < 1 then 'eval' else 'train' end as split from $flows""")
def _(t: Tables) -> DataFrame:
    return t.flows.select("frame_number", T.train_eval(F.col("frame_number")).alias("split"))


@query("prep_mask_tokens", rf"""
select doc_id, i - 1 as i, case when hit then '[MASK]' else tok end as token, case when hit then tok end as label
from (select doc_id, i, w[i] as tok, {HASH.format("doc_id || ':' || (i - 1)")} % 100 < 15 as hit
      from (select doc_id, w, unnest(generate_series(1, len(w))) as i from (select doc_id, {WORDS} as w from documents)))""")
def _(t: Tables) -> DataFrame:
    examples = T.mask_tokens(F.col("doc_id"), T.words(F.col("text")))
    placed = docs(t).select("doc_id", F.posexplode(examples).alias("i", "z"))
    return placed.select("doc_id", "i", "z.*")


@query("prep_contrastive_pairs", f"""
with b as (select frame_number as id, (row_number() over (order by frame_number) - 1) // 256 as batch from $flows),
     p as (select *, row_number() over (partition by batch order by md5('a' || id), id) as pa,
                     row_number() over (partition by batch order by md5('b' || id), id) as pb from b)
select x.batch, x.pa as slot, x.id as left_id, y.id as right_id,
       case when {HASH.format("x.id || '~' || y.id")} % 2 = 0 then 1 else -1 end as label
from p x join p y on x.batch = y.batch and x.pa = y.pb""")
def _(t: Tables) -> DataFrame:
    return T.contrastive_pairs(P.in_batches(t.flows.select("frame_number"), "frame_number", 256), "frame_number", "batch")


@query("tok_vocab_count", f"""
select token, count(*) as n from (select unnest({TOKEN_SQL}) as token from $flows) group by token having count(*) >= 1""")
def _(t: Tables) -> DataFrame:
    # The vocabulary of the flows without transport is updated with the rest.
    tokens = t.flows.select("protocol", TP.tokens().alias("tokens"))
    icmp = F.col("protocol") == "ICMP"
    old, new = T.vocabulary(tokens.where(icmp), "tokens"), T.vocabulary(tokens.where(~icmp), "tokens")
    return T.update_vocabulary(old, new)


# --- embeddings -------------------------------------------------------------


@query("embed_hashing")
def _(t: Tables) -> DataFrame:
    made = M.hashed_text(flow_texts(t, "space6"), "packet_text")
    return made.select(
        "frame_number",
        F.round(V.norm(F.col("embedding")), 6).alias("norm"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("filled"),
    )


@query("embed_blank_text", r"""
select doc_id, x = 'empty' as replaced, case when regexp_matches(lower(x), '[\p{L}\p{N}]') then 1.0::double else 0.0::double end as norm
from (select doc_id, case when regexp_replace(t, '\s+', '', 'g') = '' then 'empty' else t end as x
      from (select doc_id, case doc_id % 7 when 0 then '' when 1 then ' ' || chr(9) || ' ' else text end as t from documents))""")
def _(t: Tables) -> DataFrame:
    """Blank texts are replaced before they are embedded."""
    blanked = docs(t).withColumn(
        "text", F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 7 == 1, " \t ").otherwise(F.col("text"))
    )
    filled = blanked.withColumn("text", M.text_or_default(F.col("text")))
    made = M.hashed_text(filled, "text")
    return made.select("doc_id", (F.col("text") == M.DEFAULT_TEXT).alias("replaced"), F.round(V.norm(F.col("embedding")), 5).alias("norm"))


def letter_encoder():
    """A tiny stand-in for a user's model: relative letter and digit frequencies."""
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"

    def encode(texts):
        return np.array([[x.lower().count(s) / max(len(x), 1) for s in signs] for x in texts])

    return encode


@query("embed_encoder_hook")
def _(t: Tables) -> DataFrame:
    made = M.embed(docs(t), "text", letter_encoder)
    return made.select("doc_id", F.round(V.norm(F.col("embedding")), 6).alias("norm"))


def flow_tokens(t: Tables) -> DataFrame:
    return t.flows.select("frame_number", TP.tokens().alias("tokens"))


@query("embed_word2vec")
def _(t: Tables) -> DataFrame:
    tokens = flow_tokens(t)
    model = M.train_word2vec(tokens, "tokens", size=10, window=2)
    made = M.mean_of_tokens(tokens, "frame_number", "tokens", M.token_vectors(model), 10)
    return made.select("frame_number", F.posexplode("embedding").alias("i", "x"))


@query("embed_mean_tokens", """
with toks as (select frame_number, unnest([vid, vid + 1000000, vid // 2]) as token from (
                select frame_number, frame_len % 700 as vid from $flows)),
     dims as (select frame_number, i, avg(v[i]) as x from toks join $vectors on id = token,
              (select unnest(generate_series(1, 64)) as i) group by frame_number, i)
select f.frame_number, j - 1 as i, round(coalesce(x, 0), 6) + 0.0 as x
from $flows f cross join (select unnest(generate_series(1, 64)) as j)
left join dims d on d.frame_number = f.frame_number and d.i = j""")
def _(t: Tables) -> DataFrame:
    # Tokens are vector ids; some of them, and all of some flows, are unknown.
    vid = F.col("frame_len") % 700
    tokens = t.flows.select(
        "frame_number",
        F.array(vid, vid + 1000000, F.floor(vid / 2)).cast("array<long>").alias("tokens"),
    )
    known = vectors(t).select(F.col("id").alias("token"), F.col("embedding").alias("vector"))
    made = M.mean_of_tokens(tokens, "frame_number", "tokens", known, 64)
    return made.select("frame_number", F.posexplode("embedding").alias("i", "x")).withColumn(
        "x", F.round("x", 6) + 0.0
    )


def vectors_sql(pairs: str, cells: int) -> str:
    """Token vectors of :mod:`flowvec.operators.cooccurrence` for given ``token, context`` pairs."""
    return f"""counts as (select token, context, count(*) as n from {pairs} group by all),
     totals as (select token, sum(n) as s from counts group by token),
     weights as (select * from (select c.token, c.context,
         ln(c.n::double * (select sum(n) from counts)::double / (a.s::double * b.s::double)) as weight
       from counts c join totals a on a.token = c.token join totals b on b.token = c.context) where weight > 0),
     cells as (select token, i, sum(case when ((instr('0123456789abcdef', substr(md5(context), cast(i // 4 + 1 as integer), 1)) - 1) >> cast(3 - i % 4 as integer)) & 1 = 1
                                    then weight else -weight end) as x
       from weights, (select unnest(range({cells})) as i) group by token, i),
     vectors as (select token, i, coalesce(x, 0) as x from totals cross join (select unnest(range({cells})) as i) left join cells using (token, i))"""


ENTITY_SQL = "with " + vectors_sql("(select ip_src as token, ip_dst as context from $flows union all select ip_dst, ip_src from $flows)", 128)


def entity_vectors(t: Tables) -> DataFrame:
    return CO.token_vectors(M.entity_sentences(t.flows, "ip_src", "ip_dst"), "entities")


@query("embed_ip_entities", f"{ENTITY_SQL} select token as ip, i, round(x, 6) + 0.0 as x from vectors")
def _(t: Tables) -> DataFrame:
    made = entity_vectors(t).select(F.col("token").alias("ip"), F.posexplode("vector").alias("i", "x"))
    return made.withColumn("x", F.round("x", 6) + 0.0)


@query("knn_entity", f"""
{ENTITY_SQL}, whole as (select token, list(x order by i) as v from vectors group by token),
busiest as (select v as p from whole where token = (select ip_src from $flows group by 1 order by count(*) desc, ip_src limit 1))
select token as ip, row_number() over (order by s desc, token) as rank, round(s, 6) as score
from (select token, round(list_cosine_similarity(v, p), 9) as s from whole, busiest where list_inner_product(v, v) > 0)
qualify rank <= 10""")
def _(t: Tables) -> DataFrame:
    """Addresses nearest to the busiest one; an unknown address has none."""
    known = checkpoint(entity_vectors(t))
    busiest = A.top_values(t.flows, "ip_src", 1).first()["ip_src"]
    found = known.where(F.col("token") == busiest).first()
    target = found["vector"] if found else [0.0] * CO.CELLS
    return scored(K.knn(known, target, 10, "cosine", "token", "vector")).withColumnRenamed("id", "ip")


@query("embed_neighbours", f"""
with toks as (select frame_number, {TOKEN_SQL} as t from $flows),
     placed as (select frame_number, t[p] as token, p from (select frame_number, t, unnest(range(1, len(t) + 1)) as p from toks)),
     {vectors_sql("(select a.token, b.token as context from placed a join placed b on a.frame_number = b.frame_number and a.p <> b.p and abs(a.p - b.p) <= 2)", 16)}
select token, i, round(x, 6) + 0.0 as x from vectors""")
def _(t: Tables) -> DataFrame:
    """Vectors of the flow tokens from their neighbours two places to either side."""
    made = CO.token_vectors(flow_tokens(t), "tokens", window=2, cells=16)
    return made.select("token", F.posexplode("vector").alias("i", "x")).withColumn("x", F.round("x", 6) + 0.0)


SEQUENCE = "(select id // 8 as seq, id % 8 as p, v, case when id % 8 < 6 then 1 else 0 end as mask from $vectors)"


def sequences(t: Tables) -> DataFrame:
    """Token states of sequences of eight, the last two of them padding."""
    return vectors(t).select(
        F.floor(F.col("id") / 8).alias("seq"),
        (F.col("id") % 8).alias("p"),
        "embedding",
        F.when(F.col("id") % 8 < 6, 1).otherwise(0).alias("mask"),
    )


@query("pool_masked_mean", f"""
select seq, i - 1 as i, round(sum(v[i] * mask) / sum(mask), 6) + 0.0 as x
from {SEQUENCE}, (select unnest(generate_series(1, 64)) as i) group by seq, i""")
def _(t: Tables) -> DataFrame:
    pooled = M.pool_masked_mean(sequences(t), "seq", "embedding", "mask")
    return pooled.select("seq", F.posexplode("embedding").alias("i", "x")).withColumn(
        "x", F.round("x", 6) + 0.0
    )


@query("pool_first_token", f"""
select seq, i - 1 as i, round(v[i], 6) + 0.0 as x from {SEQUENCE}, (select unnest(generate_series(1, 64)) as i) where p = 0""")
def _(t: Tables) -> DataFrame:
    first = M.pool_first(sequences(t), "seq", "p", "embedding")
    return first.select("seq", F.posexplode(V.doubles(F.col("embedding"))).alias("i", "x")).withColumn(
        "x", F.round("x", 6) + 0.0
    )


def flow_features(t: Tables) -> DataFrame:
    """Label codes of the categories and standardised numbers of each flow."""
    rows = t.flows.select("frame_number", "ip_src", "ip_dst", "protocol", "frame_len", "src_port")
    for c in ("ip_src", "ip_dst", "protocol"):
        rows = A.encode_labels(rows, c, f"{c}_code")
    rows = A.standardize(rows.fillna({"src_port": 0}), ["frame_len", "src_port"])
    names = ["ip_src_code", "ip_dst_code", "protocol_code", "frame_len_z", "src_port_z"]
    return rows.select("frame_number", F.array(*[F.col(c).cast("double") for c in names]).alias("features"))


@query("embed_projection")
def _(t: Tables) -> DataFrame:
    made = M.project(flow_features(t), "frame_number", "features", 5)
    return made.select(
        "frame_number", F.size("embedding").alias("dim"), F.round(V.norm(F.col("embedding")), 4).alias("norm")
    )


@query("embed_pca_anomaly")
def _(t: Tables) -> DataFrame:
    return M.reconstruction_error(vectors(t), "id", "embedding", 8).orderBy(F.desc("error"), "id")


@query("embed_zero", "select frame_number, 384 as dim, 0.0::double as total from $flows")
def _(t: Tables) -> DataFrame:
    made = M.zero_embedding(t.flows.select("frame_number"))
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return made.select("frame_number", F.size("embedding").alias("dim"), total.alias("total"))


@query("embed_fallback", """
select id, label <> 4 as valid, case when label = 4 then 0.0::double else round(list_inner_product(v, v), 6) end as square,
       (select sum(case when label <> 4 then 1 else 0 end) from $vectors) as succeeded from $vectors""")
def _(t: Tables) -> DataFrame:
    # The vectors of one label stand for a batch the encoder failed on.
    failed = vectors(t).withColumn("embedding", F.expr("case when label <> 4 then embedding end"))
    filled = M.fill_failed(failed, "embedding", 64)
    succeeded = filled.agg(F.sum(F.col("valid").cast("long"))).first()[0]
    square = V.dot(F.col("embedding"), F.col("embedding"))
    return filled.select(
        "id", "valid", F.round(square, 6).alias("square"), F.lit(succeeded).alias("succeeded")
    )


@query("eval_encoder_compare")
def _(t: Tables) -> DataFrame:
    """The flows under three encoders: how well they part the protocols, and how near and how surely neighbours are found."""
    words = F.filter(TP.tokens(), lambda token: ~token.startswith("proto:"))
    flows = t.flows.select(F.col("frame_number").alias("id"), "protocol", words.alias("tokens"))
    codes = checkpoint(A.encode_labels(flows, "protocol", "label").select("id", "label", "tokens"))
    near = M.mean_of_tokens(codes, "id", "tokens", checkpoint(CO.token_vectors(codes, "tokens", cells=32)), 32)
    encoders = {
        "neighbours_32": codes.select("id", "label").join(near, "id"),
        "hashed_32": M.hashed(codes, "tokens", 32),
        "hashed_256": M.hashed(codes, "tokens", 256),
    }
    lines = []
    for encoder, embedded in encoders.items():
        rows = checkpoint(embedded.select("id", "label", "embedding"))
        labelled = rows.join(E.kmeans(rows, "id", "embedding", 5, restarts=10), "id")
        queries = K.as_queries(rows.where("id % 50 = 0"), "id", "embedding")
        truth = checkpoint(K.knn_join(queries, K.as_rows(rows, "id", "embedding"), 5, "cosine_distance"))
        found = ann.build_ivf(rows, space="unit").search(queries, 5, "cosine_distance", nprobe=3)
        scores = (
            E.purity(labelled, "label", "cluster"),
            E.silhouette_sq(labelled, "embedding", "cluster"),
            A.query_similarity(truth).agg(F.avg("similarity")).first()[0],
            ann.recall(truth, found).agg(F.avg("recall")).first()[0],
        )
        lines.append((encoder, *(float(x) for x in scores)))
    return t.spark.createDataFrame(lines, "encoder string, purity double, silhouette_sq double, similarity double, recall double")
