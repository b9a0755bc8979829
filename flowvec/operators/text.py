"""Chunking, tokenising and text preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowvec.functions.vectors import let

# Chunk sizes, special tokens, mask share in percent.
CHUNK_CHARS, CHUNK_WORDS, PARAGRAPH_CHARS = 300, 512, 500
SPECIAL_TOKENS = ["[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]"]
MAX_TOKENS = 128
MASK_PERCENT = 15


def strip(c: Column) -> Column:
    """Remove white space at both ends, line ends included."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def char_chunks(df: DataFrame, text_col: str, size: int = CHUNK_CHARS) -> DataFrame:
    """One row per ``size`` characters: ``chunk_no, chunk`` replace the text."""
    last = F.ceil(F.length(text_col) / size).cast("int") - 1
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    rest = [c for c in df.columns if c != text_col]
    numbered = df.select(*rest, text_col, F.explode(starts).alias("chunk_no"))
    piece = F.substring(F.col(text_col), F.col("chunk_no") * size + 1, F.lit(size))
    return numbered.select(*rest, "chunk_no", piece.alias("chunk"))


def word_chunks(df: DataFrame, text_col: str, size: int = CHUNK_WORDS) -> DataFrame:
    """One row per ``size`` words, the remainder kept."""
    rest = [c for c in df.columns if c != text_col]
    split = df.select(*rest, words(F.col(text_col)).alias("_w")).where(F.size("_w") > 0)
    numbers = F.sequence(F.lit(0), F.floor((F.size("_w") - 1) / size).cast("int"))
    pieces = F.transform(numbers, lambda i: F.array_join(F.slice("_w", i * size + 1, F.lit(size)), " "))
    return split.select(*rest, F.posexplode(pieces).alias("chunk_no", "chunk"))


def paragraph_chunks(df: DataFrame, text_col: str, limit: int = PARAGRAPH_CHARS) -> DataFrame:
    """Pack lines greedily while the chunk and the next line stay under ``limit``."""
    empty = F.struct(
        F.array().cast("array<string>").alias("done"), F.lit("").alias("open")
    )

    def add(acc: Column, line: Column) -> Column:
        fits = F.length(acc["open"]) + F.length(line) < limit
        flush = ~fits & (acc["open"] != "")
        done = F.when(flush, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        head = F.when(fits, acc["open"]).otherwise(F.lit(""))
        return F.struct(done.alias("done"), F.concat(head, line, F.lit("\n")).alias("open"))

    def finish(acc: Column) -> Column:
        rest = F.when(acc["open"] != "", F.array(acc["open"])).otherwise(
            F.array().cast("array<string>")
        )
        return F.concat(acc["done"], rest)

    chunks = F.aggregate(F.split(text_col, "\n"), empty, add, finish)
    rest = [c for c in df.columns if c != text_col]
    packed = df.select(*rest, F.posexplode(chunks).alias("chunk_no", "chunk"))
    return packed.withColumn("chunk", strip(F.col("chunk")))


def join_pages(
    df: DataFrame, doc: str, page_no: str, text_col: str, pages_per_step: int = 1024
) -> DataFrame:
    """Non-empty page texts of a document, each followed by a line end.

    Pages are joined in runs first, so a document of very many pages is put
    together from few long pieces.
    """
    pages = df.where(F.col(text_col) != "")

    def joined(rows: DataFrame, by: list[str], order: str, text: str) -> DataFrame:
        listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
        return rows.groupBy(*by).agg(F.array_join(F.transform(listed, lambda p: p["t"]), "").alias("text"))

    ended = pages.select(
        doc, page_no, F.concat(text_col, F.lit("\n")).alias("text"),
        F.floor(F.col(page_no) / pages_per_step).alias("_run"),
    )
    runs = joined(ended, [doc, "_run"], page_no, "text")
    return joined(runs, [doc], "_run", "text")


def pretokenize(c: Column) -> Column:
    """Lower case, address parts set apart by blanks, cut at commas and blanks."""
    quads = F.regexp_replace(
        F.lower(strip(c)), r"(\d+)\.(\d+)\.(\d+)\.(\d+)", "$1 . $2 . $3 . $4"
    )
    return F.filter(F.split(quads, "[, ]+"), lambda t: t != "")


def isolated_pieces(c: Column) -> Column:
    """Runs of separators ``, . blank`` and the pieces between them, in order."""
    return F.regexp_extract_all(strip(c), F.lit(r"[,.\s]+|[^,.\s]+"), F.lit(0))


def vocabulary(df: DataFrame, tokens_col: str, min_count: int = 1) -> DataFrame:
    """Token counts; combined map-side, so frequent tokens cost nothing extra."""
    counted = df.select(F.explode(tokens_col).alias("token")).groupBy("token")
    return counted.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def update_vocabulary(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add the counts of new sentences to an earlier vocabulary."""
    return old.unionByName(new).groupBy("token").agg(F.sum("n").alias("n"))


def pad_truncate(tokens: Column, length: int = MAX_TOKENS) -> tuple[Column, Column]:
    """Exactly ``length`` tokens, and the mask with 1 for the real ones."""
    kept = F.slice(tokens, 1, length)
    missing = F.lit(length) - F.size(kept)
    padded = F.concat(kept, F.array_repeat(F.lit(SPECIAL_TOKENS[0]), missing))
    mask = F.concat(
        F.array_repeat(F.lit(1), F.size(kept)), F.array_repeat(F.lit(0), missing)
    )
    return padded, mask


def hash_percent(c: Column, buckets: int = 100) -> Column:
    """Stable number below ``buckets`` from the digest of a value."""
    head = F.conv(F.substring(F.md5(c.cast("string")), 1, 7), 16, 10).cast("long")
    return F.pmod(head, F.lit(buckets))


def train_eval(key: Column, eval_tenths: int = 1) -> Column:
    return F.when(hash_percent(key, 10) < eval_tenths, "eval").otherwise("train")


def mask_tokens(key: Column, tokens: Column, percent: int = MASK_PERCENT) -> Column:
    """Structs ``token, label``: a share of the tokens is masked and becomes the label."""
    mask = F.lit(SPECIAL_TOKENS[4])

    def example(t: Column, i: Column) -> Column:
        place = F.concat(key.cast("string"), F.lit(":"), i.cast("string"))
        return let(
            hash_percent(place) < percent,
            lambda hit: F.struct(
                F.when(hit, mask).otherwise(t).alias("token"), F.when(hit, t).alias("label")
            ),
        )

    return F.transform(tokens, example)


def contrastive_pairs(df: DataFrame, key: str, batch: str) -> DataFrame:
    """Pair two fixed permutations of each batch; the label is 1 or -1.

    Batches have a set size, so a window holds one batch.
    """

    def permuted(seed: str, name: str) -> DataFrame:
        digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
        slot = F.row_number().over(Window.partitionBy(batch).orderBy(digest, key))
        return df.select(batch, slot.alias("slot"), F.col(key).alias(name))

    pairs = permuted("a", "left_id").join(permuted("b", "right_id"), [batch, "slot"])
    both = F.concat(F.col("left_id").cast("string"), F.lit("~"), F.col("right_id").cast("string"))
    return pairs.withColumn("label", F.when(hash_percent(both, 2) == 0, 1).otherwise(-1))


def html_text(c: Column) -> Column:
    """Visible text of a page: no comments, scripts, styles or tags; entities decoded."""
    text = c
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script>", r"(?is)<style\b.*?</style>"):
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", "")
    # The named entities of the test pages; the ampersand comes last.
    for name, sign in {
        "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&",
    }.items():
        text = F.replace(text, F.lit(name), F.lit(sign))
    return text
