"""The registered queries ``opN_<name>`` and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    collocations, jaccard, language, licenses, neighbours, packing, quality, records, runs, sentencepiece,
    simhash, toxicity, winnow,
)
from .corpus import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def judged(docs: DataFrame, folds: int, held: int, score, threshold: float) -> DataFrame:
    return docs.select(
        "doc_id", (fold("doc_id", folds) == held).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold("doc_id", 3) != 1))
    return judged(docs, 3, 1, toxicity.score(model), toxicity.THRESHOLD)


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(fold("doc_id", 3) != 1))
    return judged(docs, 3, 1, quality.score(model), quality.THRESHOLD)


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PLACED = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packed(docs: DataFrame, remembered: int | None = None) -> DataFrame:
    """Documents cut, checksummed and packed; the ids themselves stay in the tasks that made them."""
    cut = packing.pieces(docs, vocabulary("byte_bpe_50k.json"), remembered=remembered)
    items = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(items, ["doc_id", "piece", "ids_crc32"]).select(*PLACED)


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query
def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = records.shared_folder(spark)
    records.write(table(spark, sf_dir, "documents"), folder, vocabulary("word_bpe_49k.json"), 2)
    return records.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(fold("doc_id", 4) != 2))
    return docs.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), language.predict(model).alias("_p")
    ).select("doc_id", "held_out", "_p.*")


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.compare(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256",
        winnow.written("entries").alias("fingerprint"),
        winnow.written("edited_entries").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), size=4, percent=85)


ORACLES["op8_jaccard"] = r"""
with recursive words as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as w
    from documents
), sets as (
    select doc_id, list_distinct(case
        when len(w) = 0 then []::varchar[]
        when len(w) < 4 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s
    from words
), grams as (
    select doc_id, len(s) as n, unnest(s) as g from sets
), pairs as (
    select a.doc_id as a, b.doc_id as b, a.n as na, b.n as nb, count(*) as o
    from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
        and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
    group by all
), links as (
    select a, b from pairs where 100 * o >= 85 * (na + nb - o)
), reach as (
    select doc_id as a, doc_id as b from sets
    union
    select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, len(s.s)::bigint as n_shingles, c.component_id, coalesce(k.n_links, 0)::bigint as n_links
from sets s
join (select a, min(b) as component_id from reach group by a) c on c.a = s.doc_id
left join (select a, count(*) as n_links from links group by a) k on k.a = s.doc_id
"""


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), "id % 50 = 0", k=5)


@query
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and a checksum of the text that they decode to."""
    model = vocabulary("piece_bpe_32k.model")
    coded = sentencepiece.decode(sentencepiece.encode(table(spark, sf_dir, "documents"), model), model)
    return coded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the last words of a tenth of the texts, by a hash of the id, made periodic."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    return (
        chosen.selectExpr("*", "size(w) as n", "h div 10 as g")
        .selectExpr("*", "cast(if(n > 0, g % n, 0) as int) as a")
        .selectExpr("*", "cast(1 + (n - a) div (3 + g % 8) as int) as p")
        .selectExpr(
            "doc_id",
            "if(h % 10 = 0 and n > 0, array_join(concat(slice(w, 1, a), slice(flatten(array_repeat("
            "slice(w, a + 1, p), cast(1 + (n - a) div p as int))), 1, n - a)), ' '), text) as text",
        )
    )


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    line = "concat(r.start, ',', r.length, ',', r.period, '\n')"
    return found.selectExpr("*", f"{best} as b").selectExpr(
        "doc_id", "cast(size(runs) as long) as n_runs", "-b.start as start", "b.length as length",
        "-b.period as period", "1000 * b.length div -b.period as exponent_milli",
        f"sha2(array_join(transform(runs, r -> {line}), ''), 256) as runs_sha256",
        "sha2(collapsed, 256) as collapsed_sha256",
    )


ORACLES["op11_runs"] = r"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
        xor(4294967295, list_reduce(
            list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
            lambda crc, byte: list_reduce(
                list_prepend(xor(crc, byte), range(8)),
                lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end))) as h
    from documents
), places as (
    select *, len(w) as n, case when len(w) > 0 then (h // 10) % len(w) end as a from words
), periods as (
    select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from places
), edited as (
    select doc_id, n, case when h % 10 = 0 and n > 0
        then list_transform(range(n), lambda i: w[case when i >= a then a + (i - a) % p else i end + 1]) else w end as w
    from periods
), placed as (
    select doc_id, n, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from edited
), equal as (
    select x.doc_id, y.i - x.i as q, x.i from placed x join placed y
    on x.doc_id = y.doc_id and x.word = y.word and x.i < y.i and 4 * (y.i - x.i) <= x.n
), islands as (
    select *, i - row_number() over (partition by doc_id, q order by i) as island from equal
), stretches as (
    select doc_id, q, min(i) as start, count(*) + q as length from islands
    group by doc_id, q, island having count(*) + q >= greatest(6, 4 * q)
), runs as (
    select doc_id, start, length, min(q) as period from stretches group by doc_id, start, length
), told as (
    select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as listed,
        first(struct_pack(start := start, length := length, period := period) order by length desc, start, period) as b
    from runs group by doc_id
), kept as (
    select doc_id, string_agg(word, ' ' order by i) as collapsed from placed x
    where not exists (select 1 from runs r where r.doc_id = x.doc_id and r.start + r.period <= x.i and x.i < r.start + r.length)
    group by doc_id
)
select e.doc_id, coalesce(t.n_runs, 0)::bigint as n_runs, t.b.start::bigint as start, t.b.length::bigint as length,
    t.b.period::bigint as period, (1000 * t.b.length // t.b.period)::bigint as exponent_milli,
    sha256(coalesce(t.listed, '')) as runs_sha256, sha256(coalesce(k.collapsed, '')) as collapsed_sha256
from edited e left join told t on t.doc_id = e.doc_id left join kept k on k.doc_id = e.doc_id
"""


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(simhash.fingerprints(table(spark, sf_dir, "documents"), size=4), radius=4)
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), top=2000, least=10)


ORACLES["op13_collocations"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as w
    from documents
), starts as (
    select lang, w, unnest(range(1, len(w) + 1)) as i from pieces
), grams as (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase, count(*) as f,
        any_value(w[i]) as w1, any_value(case when k > 1 then array_to_string(w[i + 1:i + k - 1], ' ') end) as rest1,
        any_value(case when k > 2 then array_to_string(w[i:i + 1], ' ') end) as first2, any_value(w[i + k - 1]) as rest2
    from starts cross join (select unnest([1, 2, 3]) as k) where i + k - 1 <= len(w)
    group by all
), totals as (
    select lang, sum(f)::bigint as n from grams where k = 1 group by lang
), cuts as (
    select g.lang, g.k, g.phrase, g.rest1, g.first2, g.f as a, l1.f as l1, r1.f as r1, l2.f as l2, r2.f as r2,
        1000000::hugeint * g.f * g.f // (l1.f::hugeint * r1.f) as s1,
        1000000::hugeint * g.f * g.f // (l2.f::hugeint * r2.f) as s2
    from grams g
    join grams l1 on l1.lang = g.lang and l1.phrase = g.w1
    join grams r1 on r1.lang = g.lang and r1.phrase = g.rest1
    left join grams l2 on l2.lang = g.lang and l2.phrase = g.first2
    left join grams r2 on r2.lang = g.lang and r2.phrase = g.rest2
    where g.k > 1 and g.f >= 10
), around as (
    select lang, phrase, max(a) as most from (
        select lang, first2 as phrase, a from cuts where k = 3
        union all select lang, rest1, a from cuts where k = 3) group by lang, phrase
), best as (
    select c.lang, c.phrase, c.a, case when c.k = 3 and c.s2 < c.s1 then c.l2 else c.l1 end as l,
        case when c.k = 3 and c.s2 < c.s1 then c.r2 else c.r1 end as r,
        (case when c.k = 3 and c.s2 < c.s1 then c.s2 else c.s1 end)::bigint as score
    from cuts c left join around o on o.lang = c.lang and o.phrase = c.phrase
    where c.k = 3 or o.most is null or 100 * o.most < 50 * c.a
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase,
    a::bigint as a, l::bigint as l, r::bigint as r, n, score
from best join totals using (lang)
qualify rank <= 2000
"""
