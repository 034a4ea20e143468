"""Benchmark decontamination by winnowing, in DataFrame functions alone.

A text's words are hashed into grams of ``k`` consecutive words, and of every ``w`` consecutive grams
the least hash is kept as a fingerprint. With ``k + w - 1`` words in a window, two texts that share a
window keep the same gram of it, so no shared window is missed. Fingerprints of all texts meet those
of the benchmark; only texts with a hit are looked at again, and there every window around a hit is
compared with the benchmark's windows word by word.

No pairs of occurrences are formed: a text meets the *distinct* fingerprints, then the *distinct*
windows of the benchmark. Windows that occur in the same items share one set of items, and texts that
touch the same sets share one list of items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import column
from ..sources.scratch import materialize
from .common import fresh, row_key, text_of

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE = 1 << 14  # words of a text handled at once; pieces overlap by a window less a word


def words_of(text: Column) -> Column:
    """The words of a text, as written; letter case is settled by :func:`folded` where it matters."""
    return F.array_remove(F.split(text, SEPARATORS), "")


def folded(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def _ahead(values: Column, by: int) -> Column:
    return F.slice(values, by + 1, F.size(values))


def _grams(df: DataFrame, words: str, size: int, out: str) -> DataFrame:
    """Add hashes of ``size`` consecutive words; those that would run past the end mean nothing.

    Words equal but for the case of A-Z have equal hashes. Grams of 1, 2, 4, ... words are built
    from each other, and joined by the binary digits of ``size``. Every step is a column of its own, so that
    none is computed twice.
    """
    power, step = fresh(df, "power", "step")

    def joined(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))

    df = df.withColumn(power, F.transform(column(words), lambda w: F.xxhash64(F.lower(w))))
    span, covered = 1, 0
    while True:
        if size & span:
            have = joined(F.col(out), _ahead(F.col(power), covered)) if covered else F.col(power)
            df = df.withColumn(out, have)
            covered += span
        span *= 2
        if span > size:
            return df.drop(power)
        df = df.withColumn(step, joined(F.col(power), _ahead(F.col(power), span // 2)))
        df = df.drop(power).withColumnRenamed(step, power)


def _least(df: DataFrame, grams: str, width: int) -> DataFrame:
    """Replace each gram by the least of ``width`` from it on."""
    span = 1
    while span < width:
        by = min(span, width - span)
        ahead = F.zip_with(F.col(grams), _ahead(F.col(grams), by), lambda a, b: F.least(a, b))
        df, span = df.withColumn(grams, ahead), span + by
    return df


def with_prints(df: DataFrame, words: str, size: int, out: str) -> DataFrame:
    """Add the fingerprint of each window of ``size`` words, by the window's place."""
    k = max(1, size * 2 // 5)
    df = _least(_grams(df, words, k, out), out, size - k + 1)
    return df.withColumn(out, F.slice(F.col(out), 1, F.greatest(F.size(words) - (size - 1), F.lit(0))))


def _in_pieces(df: DataFrame, words: str, base: str, overlap: int) -> DataFrame:
    """A row for each piece of a text, at least one; ``base`` is the number of words before it."""
    piece = fresh(df, "piece")[0]
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - 1, F.lit(0)), F.lit(PIECE))

    def cut(at: Column) -> Column:
        return F.struct(at.alias("at"), F.slice(F.col(words), at + 1, PIECE + overlap).alias("words"))

    rest = [F.col(c) for c in df.columns if c != words]
    cuts = df.select(*rest, F.explode(F.transform(starts, cut)).alias(piece))
    return cuts.select(*rest, F.col(f"{piece}.at").alias(base), F.col(f"{piece}.words").alias(words))


def _shown(words: Column, at: Column, size: int) -> Column:
    return folded(F.array_join(F.slice(words, at + 1, size), " "))


def benchmark_windows(
    benchmark: DataFrame, id_col: str, text_col: str, window: int
) -> tuple[DataFrame, list[int]]:
    """(item, size, print, shown) for every window of every item, and the sizes there are.

    ``size`` is under ``window`` for items that are shorter. ``item`` is the id as text; items
    without an id count as one, ''."""
    item = F.coalesce(column(id_col).cast("string"), F.lit(""))
    items = benchmark.select(item.alias("item"), words_of(text_of(text_col)).alias("words"))
    items = items.withColumn("size", F.least(F.size("words"), F.lit(window)))
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most ``window`` + 1
    items = _in_pieces(items, "words", "base", window - 1)

    def of_size(size: int) -> DataFrame:
        some = with_prints(items.where(F.col("size") == size), "words", size, "print")
        windows = F.transform(
            F.col("print"),
            lambda p, i: F.struct(p.alias("print"), _shown(F.col("words"), i, size).alias("shown")),
        )
        return some.select("item", F.lit(size).alias("size"), F.inline(windows)).distinct()

    sizes = sorted({size for size in sizes if size} or {window})
    return reduce(DataFrame.unionByName, map(of_size, sizes)), sizes


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str,
    text_col: str,
    item_col: str,
    item_text_col: str,
    window: int = 10,
) -> DataFrame:
    """What every text shares with the benchmark, one row for each row of ``df``.

    Words are runs of letters and digits, and all of Unicode beyond ASCII counts as letters; A-Z is
    read as a-z. A word is hit if it lies in ``window`` consecutive words that some item also has; an item of fewer
    words counts as one window, an item without words as none. Columns: the id, ``n_words``,
    ``n_hit``, ``spans`` (first word and end of the hit runs, counted from 0, end exclusive),
    ``items`` (ids of the items met, as text, in order) and ``contaminated``.

    Null and empty texts have no words. Repeated rows and null ids are judged like any other. Items
    that share an id are one item, and all items without an id are the item ''. Other columns are
    left out. Empty tables are fine on either side.

    Memory holds ``PIECE`` words of a text at once and, for one text, its hit positions and items.
    """
    if window < 1:
        raise ValueError("window must be at least 1")
    windows, sizes = benchmark_windows(benchmark, item_col, item_text_col, window)
    windows = materialize(windows, "winnow-benchmark")
    k1, k2 = row_key(id_col, text_col)
    docs = df.select(
        column(id_col).alias("id"), k1.alias("k1"), k2.alias("k2"), text_of(text_col).alias("text")
    )
    printed = materialize(_printed(docs, sizes, window), "winnow-prints")
    hits = _hits(docs, printed, windows, sizes, window)
    found = materialize(_spans(hits), "winnow-hits")
    lists = _lists(found, windows)

    rows = printed.where("base = 0").select("id", "n_words", "k1", "k2")
    # Lists go to the few texts with hits first, so texts without one never gather on a null signature
    listed = found.drop("sets").join(lists, "signature")
    rows = rows.join(listed, ["k1", "k2"], "left")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def _printed(docs: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(id, k1, k2, n_words, base, prints): the distinct fingerprints of each piece of each text."""
    cut = docs.select("id", "k1", "k2", words_of(F.col("text")).alias("words"))
    cut = _in_pieces(cut.withColumn("n_words", F.size("words")), "words", "base", window - 1)
    for size in sizes:
        cut = with_prints(cut, "words", size, f"of_{size}")
    prints = F.concat(F.array().cast("array<bigint>"), *[F.col(f"of_{size}") for size in sizes])
    return cut.select("id", "k1", "k2", "n_words", "base", F.array_distinct(prints).alias("prints"))


def _hits(
    docs: DataFrame, printed: DataFrame, windows: DataFrame, sizes: list[int], window: int
) -> DataFrame:
    """(k1, k2, start, size, set): every window of every text that the benchmark also has.

    ``set`` stands for the items with that window.
    """
    met = printed.select("k1", "k2", "base", F.explode("prints").alias("print"))
    met = met.join(windows.select("print").distinct(), "print", "left_semi")
    pieces = met.groupBy("k1", "k2", "base").agg(F.collect_set("print").alias("met"))
    pieces = pieces.groupBy("k1", "k2").agg(F.collect_list(F.struct("base", "met")).alias("pieces"))

    texts = docs.select("k1", "k2", "text").join(pieces, ["k1", "k2"])
    texts = texts.select("k1", "k2", "pieces", words_of(F.col("text")).alias("words"))

    def cut(piece: Column) -> Column:
        words = F.slice(F.col("words"), piece["base"] + 1, PIECE + window - 1)
        return F.struct(piece["base"].alias("base"), piece["met"].alias("met"), words.alias("words"))

    texts = texts.select("k1", "k2", F.inline(F.transform("pieces", cut)))
    for size in sizes:
        texts = with_prints(texts, "words", size, f"of_{size}")
        hit = F.transform(f"of_{size}", lambda p, i: F.when(F.array_contains("met", p), i))
        texts = texts.withColumn(f"near_{size}", F.array_compact(hit)).drop(f"of_{size}")
    windows_near = [_near_windows(size) for size in sizes]
    none = F.array().cast("array<struct<start:int,size:int,shown:string>>")
    around = texts.select("k1", "k2", F.inline(F.concat(none, *windows_near)))
    of_window = windows.groupBy("shown").agg(_named(F.collect_set("item")).alias("set"))
    return around.join(of_window, "shown").select("k1", "k2", "start", "size", "set")


def _near_windows(size: int) -> Column:
    """The windows at the places ``near_<size>`` of a piece."""

    def at(i: Column) -> Column:
        return F.struct(
            (F.col("base") + i).alias("start"),
            F.lit(size).alias("size"),
            _shown(F.col("words"), i, size).alias("shown"),
        )

    return F.transform(f"near_{size}", at)


def _named(items: Column) -> Column:
    """What stands for a set of items: a digest of their ids in order."""
    return F.unhex(F.sha2(F.to_json(F.array_sort(items)), 256))


def _spans(hits: DataFrame) -> DataFrame:
    """(k1, k2, n_hit, spans, sets, signature) for each text with hits."""
    per_text = hits.groupBy("k1", "k2").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("parts"),
        F.array_sort(F.collect_set("set")).alias("sets"),
    )
    # A part is a run's first word unless it begins inside what came before; sorted by start, the
    # greatest end so far is that of the run.
    opened = F.lit(None).cast("struct<start:int,end:int>")
    state = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), opened.alias("open"))

    def grow(run: Column, part: Column) -> Column:
        apart = run["open"].isNull() | (part["start"] > run["open"]["end"])
        longer = F.struct(
            run["open"]["start"].alias("start"), F.greatest(run["open"]["end"], part["end"]).alias("end")
        )
        done = F.when(apart & run["open"].isNotNull(), F.concat(run["done"], F.array(run["open"])))
        return F.struct(
            F.coalesce(done, run["done"]).alias("done"),
            F.when(apart, part).otherwise(longer).alias("open"),
        )

    runs = F.aggregate("parts", state, grow, lambda run: F.concat(run["done"], F.array(run["open"])))
    return per_text.select("k1", "k2", "sets", runs.alias("spans")).select(
        "k1",
        "k2",
        F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        "spans",
        "sets",
        F.sha2(F.array_join(F.transform("sets", lambda s: F.hex(s)), ""), 256).alias("signature"),
    )


def _lists(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(signature, items): the items of all sets in a signature, each list made once."""
    sets = windows.groupBy("shown").agg(F.array_sort(F.collect_set("item")).alias("members"))
    sets = sets.groupBy(_named(F.col("members")).alias("set")).agg(F.first("members").alias("members"))
    wanted = found.groupBy("signature").agg(F.first("sets").alias("sets"))
    wanted = wanted.select("signature", F.explode("sets").alias("set")).join(sets, "set")
    items = wanted.select("signature", F.explode("members").alias("item"))
    return items.groupBy("signature").agg(F.array_sort(F.collect_set("item")).alias("items"))
