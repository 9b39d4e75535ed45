"""Document fingerprints by winnowing, with built-in functions only.

A text's words (cut at spaces) are hashed, and a polynomial over K of them in a row is the hash of
a k-gram; both the polynomial and the minimum over a window of W k-grams are built in doubling
steps, each of which shares the work of overlapping windows. Of every window the least hash is
selected, the rightmost of equal ones, and kept with its position: two texts that share any
W + K - 1 words in a row share a selected hash. A selected entry is one long: the hash above 31
bits, the complement of the position below, so the plain minimum breaks ties to the right.

Defined results: a null text counts as empty. A text of fewer than K words has one entry, the hash
of all of it; so every text has a fingerprint, and equal texts have equal ones. A text with fewer
than W k-grams has the least of them. Documents follow each other by descending id, rows of equal
id by a hash of their text, null ids last; the last is followed by the first. Of one document
alone, it is itself the next. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, W = 5, 16
PRIME, BASE = (1 << 31) - 1, 1_000_003
LOW = (1 << 31) - 1
#: Documents are dealt by id into about N / ROWS ranges, at most QUANTILES * FINEST of them, so the
#: first rows of all ranges are few enough to broadcast whatever the input.
QUANTILES, FINEST, ROWS = 64, 128, 200


def _shifted(name: str, by: int) -> Column:
    return F.slice(name, by + 1, F.greatest(F.size(name), F.lit(1)))


def _joined(df: DataFrame, names: list[str], by: int, both) -> DataFrame:
    return df.withColumns({n: F.zip_with(n, _shifted(n, by), both) for n in names})


def with_fingerprints(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``df`` with a column of selected entries (array of long) for each text column.

    ``texts`` maps the new columns to the text columns. Each step is a projection of its own, so
    no expression is evaluated twice.
    """
    names = list(texts)
    grams = {n: f"_{n}_words" for n in names}
    df = df.withColumns({grams[n]: F.split(F.coalesce(F.col(t), F.lit("")), " ") for n, t in texts.items()})
    df = df.withColumns(
        {
            n: F.when(
                F.size(grams[n]) >= K,
                F.transform(grams[n], lambda w: F.crc32(w.cast("binary")) % PRIME),
            ).otherwise(F.array(F.crc32(F.coalesce(F.col(t), F.lit("")).cast("binary")) % PRIME))
            for n, t in texts.items()
        }
    ).withColumns({f"_{n}_n": F.greatest(F.size(grams[n]) - (K - 1), F.lit(1)) for n in names})
    df = df.drop(*grams.values())
    word = {n: f"_{n}_word" for n in names}
    df = df.withColumns({word[n]: F.col(n) for n in names})
    df = _joined(df, names, 1, lambda a, b: (a * BASE + b) % PRIME)
    df = _joined(df, names, 2, lambda a, b: (a * (BASE * BASE % PRIME) + b) % PRIME)
    df = df.withColumns(
        {
            n: F.when(
                F.size(word[n]) >= K,
                F.zip_with(n, _shifted(word[n], 4), lambda a, b: (a * BASE + b) % PRIME),
            ).otherwise(F.col(word[n]))
            for n in names
        }
    ).drop(*word.values())
    df = df.withColumns(
        {
            n: F.transform(
                F.slice(n, 1, F.col(f"_{n}_n")), lambda g, i: g * (LOW + 1) + (F.lit(LOW) - i)
            )
            for n in names
        }
    )
    for step in (1, 2, 4, 8):
        df = _joined(df, names, step, lambda a, b: F.least(a, b))
    chosen = {
        n: F.array_distinct(F.slice(n, 1, F.greatest(F.col(f"_{n}_n") - (W - 1), F.lit(1)))) for n in names
    }
    return df.withColumns(chosen).drop(*(f"_{n}_n" for n in names))


def hashes(entries: str | Column) -> Column:
    """The different hashes of selected entries."""
    return F.array_distinct(F.transform(entries, lambda e: F.shiftright(e, 31)))


def written(entries: str | Column) -> Column:
    """Entries as text, ``hash@position`` in order."""
    return F.concat_ws(
        " ",
        F.transform(
            entries,
            lambda e: F.concat(
                F.hex(F.shiftright(e, 31)), F.lit("@"), (F.lit(LOW) - e.bitwiseAND(LOW)).cast("string")
            ),
        ),
    )


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets of hashes."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def ranges(docs: DataFrame) -> tuple[DataFrame, Window]:
    """Documents in ranges of ids, and the window in which each is followed by the next document.

    A range also gets a copy (``_guest``) of the first document of the range that follows. Texts
    are shuffled once. Columns: doc_id, text, _range, _guest, _key, _tie.
    """
    points = [i / QUANTILES for i in range(1, QUANTILES)]
    n, least, most, cuts = docs.agg(
        F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id"),
        F.percentile_approx("doc_id", points, 10_000),
    ).first()
    least, most = (0, 0) if least is None else (least - 1, most)
    edges = sorted({least, *(cuts or []), most + 1})
    fine = min(FINEST, max(1, -(-n // (QUANTILES * ROWS))))
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(least)).cast("long").alias("_key"))
    place = F.lit(0).cast("int")
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = ((F.col("_key") - low) * fine / (high - low)).cast("int") + i * fine
        place = F.when(F.col("_key") >= low, inside).otherwise(place)
    keyed = keyed.withColumn("_range", place)
    # The first document of each range, and the range it follows: at most QUANTILES * FINEST rows.
    tops = sorted(
        (r._range, r.top) for r in keyed.groupBy("_range").agg(F.max("_key").alias("top")).collect()
    )
    hosts = [place for place, _ in tops[1:] + tops[:1]]
    guests = docs.sparkSession.createDataFrame(
        [(top, host) for (_, top), host in zip(tops, hosts)], "_top long, _host int"
    )
    copies = F.when(
        F.col("_host").isNotNull(),
        F.array(
            F.struct(F.col("_range").alias("place"), F.lit(False).alias("guest")),
            F.struct(F.col("_host").alias("place"), F.lit(True).alias("guest")),
        ),
    ).otherwise(F.array(F.struct(F.col("_range").alias("place"), F.lit(False).alias("guest"))))
    rows = (
        keyed.join(F.broadcast(guests), F.col("_key") == F.col("_top"), "left")
        .select("doc_id", "text", "_key", F.explode(copies).alias("_at"))
        .select(
            "doc_id", "text", F.col("_at.place").alias("_range"), F.col("_at.guest").alias("_guest"),
            "_key", F.xxhash64("text").alias("_tie"),
        )
    )
    return rows, Window.partitionBy("_range").orderBy("_guest", F.desc("_key"), "_tie")


def compare(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness.

    The edited text ends with the start of the next document, as many code points as half of the
    text has. Columns: doc_id, n_chars, edited_sha256, entries, edited_entries (arrays of long),
    near_edited, near_next.
    """
    rows, order = ranges(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = (
        rows.withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("_next", F.lead("text").over(order))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn(
            "_edited",
            F.concat(
                F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half),
            ),
        )
        .drop("_next")
        .withColumn("edited_sha256", F.sha2("_edited", 256))
    )
    rows = with_fingerprints(rows, {"entries": "text", "edited_entries": "_edited"})
    rows = (
        rows.drop("text", "_edited")
        .withColumns({"_own": hashes("entries"), "_new": hashes("edited_entries")})
        .withColumn("_after", F.lead("_own").over(order))
        .where(~F.col("_guest"))
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "entries", "edited_entries",
        likeness("_own", "_new").alias("near_edited"), likeness("_own", "_after").alias("near_next"),
    )
