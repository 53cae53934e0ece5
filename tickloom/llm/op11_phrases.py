"""Phrase collocations by set-oriented relational mining of occurrences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import table
from tickloom.llm.files import opened
from tickloom.llm.words import distinct, encoded, hashes, mixed, spread
from tickloom.session import scratch

LONGEST = 4
LEAST = 30  # occurrences of a candidate
COVERED = 80  # percent of a candidate's occurrences that, inside one longer candidate, drop it
FIRST = 2000  # phrases reported for a language
SCALE = 2_000_000
UNKNOWN = "und"

CHUNK_BYTES = 4 << 20  # text whose occurrences a task holds at a time; a longer piece comes whole
HASHED = 1 << 16  # words hashed together
READ = 256  # documents taken from Spark's batches together
SECTION = 1 << 14  # groups of words in one row of a relation
BUCKET_WORDS = 1 << 20  # words of the corpus for each bucket that longer groups are counted in
ROW_GROUP = 16 << 20
GROUP_BITS, COUNTER_BITS = 28, 15  # a group's number in its chunk, a chunk's in its task

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, bool)
_BREAK[np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8)] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9]] = True


def occurrences(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, begins and ends of words, and their places: adjacent words of a piece
    have consecutive places, and each new piece leaves one place out."""
    data = _LOWER[np.frombuffer(text + b"\n", np.uint8)]
    apart = _BREAK[data]
    inside = ~(apart | _SPACE[data])
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    begin, end = edge[0::2], edge[1::2]
    piece = np.cumsum(apart, dtype=np.int32)[begin]
    new = np.zeros(len(begin), np.int64)
    new[1:] = piece[1:] != piece[:-1]
    return data, begin, end, np.arange(len(begin)) + np.cumsum(new)


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of words, made for a part of the bytes at a time."""
    found = [np.zeros(0, np.uint64)]
    for i in range(0, len(begin), HASHED):
        low, first, last = begin[i], begin[i : i + HASHED], end[i : i + HASHED]
        found.append(hashes(data[low : last[-1]], first - low, last - low))
    return np.concatenate(found)


def parts(text: bytes) -> Iterator[bytes]:
    """A text in stretches of about CHUNK_BYTES that end between pieces."""
    while len(text) > CHUNK_BYTES:
        ends = np.flatnonzero(_BREAK[np.frombuffer(text, np.uint8, offset=CHUNK_BYTES)])
        cut = CHUNK_BYTES + int(ends[0]) + 1 if len(ends) else len(text)
        yield text[:cut]
        text = text[cut:]
    if text:
        yield text


def gaps(at: np.ndarray) -> bytes:
    return np.diff(at, prepend=0).astype("<u4").tobytes()


def places(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64))


def in_sections(
    at: np.ndarray, group: np.ndarray, values: list[pa.Array], begins: list[int]
) -> tuple[pa.Array, list[pa.Array], list[pa.Array]]:
    """The columns of a chunk's rows: ``base``, ``at`` and ``grp`` (in the first row), and lists of the groups' values."""
    begins = begins or [0]
    cuts = pa.array([*begins, len(values[0])], pa.int32())
    heads = [[raw, *[None] * (len(begins) - 1)] for raw in (gaps(at), group.astype("<u4").tobytes())]
    lists = [pa.ListArray.from_arrays(cuts, v) for v in values]
    return pa.array(begins, pa.int64()), [pa.array(h, pa.binary()) for h in heads], lists


def first_relation(documents: DataFrame, text: str, lang: str) -> DataFrame:
    """Occurrences of single words in chunks of one language each, sorted by place.

    A chunk's first row has the places of its occurrences (``at``) and the number of each
    one's group (``grp``). Its groups' words and counts follow in sections, of which ``base`` is
    the number of the first group.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def chunk(name: str) -> pa.RecordBatch:
            nonlocal made
            data, begin, end, at = occurrences(b"\n".join(held.pop(name)))
            size.pop(name)
            _, first, group = distinct(word_hashes(data, begin, end))
            words = pa.array([data[begin[i] : end[i]].tobytes().decode() for i in first], pa.string())
            number = (task << COUNTER_BITS) | made
            made += 1
            if made >> COUNTER_BITS or len(words) >> GROUP_BITS:
                raise ValueError("a task has too many chunks or a chunk too many words; use smaller input splits")
            count = pa.array(np.bincount(group, minlength=len(words)), pa.int64())
            base, heads, lists = in_sections(at, group, [words, count], list(range(0, len(words), SECTION)))
            same = [pa.array([x] * len(base), t) for x, t in ((number, pa.int64()), (name, pa.string()))]
            n = pa.array([len(at), *[0] * (len(base) - 1)], pa.int64())
            return pa.RecordBatch.from_arrays(
                [*same, n, base, *heads, *lists], names=["chunk", "lang", "n", "base", "at", "grp", "word", "count"]
            )

        for batch in (b.slice(i, READ) for b in batches for i in range(0, b.num_rows, READ)):
            for name, whole in zip(batch.column(1).to_pylist(), encoded(batch.column(0).to_pylist())):
                for part in parts(whole):
                    held.setdefault(name, []).append(part)
                    size[name] = size.get(name, 0) + len(part)
                    if size[name] >= CHUNK_BYTES:
                        yield chunk(name)
        for name in list(held):
            yield chunk(name)

    schema = "chunk long, lang string, n long, base long, at binary, grp binary, word array<string>, count array<long>"
    rows = documents.select(F.col(text).cast("string"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)))
    return rows.mapInArrow(work, schema)


LONGS = pa.list_(pa.int64())
RELATION = pa.schema(
    {
        "chunk": pa.int64(),
        "bucket": pa.int64(),
        "base": pa.int64(),
        "at": pa.binary(),
        "grp": pa.binary(),
        "first": LONGS,
        "last": LONGS,
        "count": pa.list_(pa.int32()),
    }
)
RELATION_COLUMNS = (
    "chunk long, bucket long, base long, at binary, grp binary, first array<long>, last array<long>, count array<int>"
)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """Values of a column, or of all its lists end to end."""
    if pa.types.is_list(column.type):
        column = pa.chunked_array([c.flatten() for c in column.chunks], column.type.value_type)
    return column.to_numpy()


def longer(relation: pa.Table, frequent: pa.Table, buckets: int) -> pa.Table:
    """Occurrences one word longer, of one chunk.

    The chunk's relation keeps the occurrences of its frequent groups; it and itself are merged
    where the places are adjacent, so both the first and the last words are frequent. The new
    groups are sorted by bucket, a function of their parts, and by their parts.
    """
    if not relation.num_rows or not frequent.num_rows:
        return RELATION.empty_table()
    at = places(relation["at"][0].as_py())
    group = np.frombuffer(relation["grp"][0].as_py(), "<u4").astype(np.int64)
    ids = np.full(int(group.max()) + 1, -1, np.int64)
    ids[flat(frequent["grp"])] = flat(frequent["id"])
    kept = ids[group] >= 0
    at, group = at[kept], group[kept]
    next_to = np.flatnonzero(at[1:] == at[:-1] + 1)
    pair = group[next_to] * len(ids) + group[next_to + 1]
    keys, number, count = np.unique(pair, return_inverse=True, return_counts=True)
    first, last = ids[keys // len(ids)], ids[keys % len(ids)]
    bucket = (mixed(mixed(first.view(np.uint64)) + last.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((last, first, bucket))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    bucket = bucket[order]
    begins = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    values = [pa.array(first[order], pa.int64()), pa.array(last[order], pa.int64()), pa.array(count[order], pa.int32())]
    base, heads, lists = in_sections(at[next_to], rank[number], values, begins)
    chunk = pa.array([relation["chunk"][0].as_py()] * len(base), pa.int64())
    of_row = pa.array(bucket[begins] if begins else [0], pa.int64())
    return pa.Table.from_arrays([chunk, of_row, base, *heads, *lists], schema=RELATION)


FREQUENT = pa.schema({"chunk": pa.int64(), "grp": LONGS, "id": LONGS, "first": LONGS, "last": LONGS, "f": LONGS})
FREQUENT_COLUMNS = "chunk long, grp array<long>, id array<long>, first array<long>, last array<long>, f array<long>"


def counted(sections: pa.Table, least: int, of_chunks: bool) -> pa.Table:
    """Frequent groups of one bucket, from its sections of all chunks.

    The first row has the groups: ``id`` (the place of the first row with it), parts and
    occurrences ``f``. The others say for each chunk which of its groups are frequent.
    """
    length = pc.list_value_length(sections["first"]).to_numpy().astype(np.int64)
    chunk = np.repeat(sections["chunk"].to_numpy(), length)
    where = (chunk << GROUP_BITS) | spread(sections["base"].to_numpy(), length)
    first, last, count = (flat(sections[c]) for c in ("first", "last", "count"))
    order = np.lexsort((where, last, first))
    first, last, where, count = first[order], last[order], where[order], count[order].astype(np.int64)
    new = np.ones(len(order), bool)
    new[1:] = (first[1:] != first[:-1]) | (last[1:] != last[:-1])
    begins = np.flatnonzero(new)
    total = np.add.reduceat(count, begins) if len(begins) else count
    often = total >= least
    begins_often = begins[often]
    rows = [(None, [], where[begins_often], first[begins_often], last[begins_often], total[often])]
    if of_chunks:
        kept = np.repeat(often, np.diff([*begins, len(order)]))
        ids, mine = np.repeat(where[begins], np.diff([*begins, len(order)]))[kept], where[kept]
        by_place = np.argsort(mine)
        ids, mine = ids[by_place], mine[by_place]
        of_row = mine >> GROUP_BITS
        cuts = np.flatnonzero(np.diff(of_row)) + 1
        for number, group, id_ in zip(of_row[[0, *cuts]] if len(mine) else [], np.split(mine, cuts), np.split(ids, cuts)):
            rows.append((int(number), group & ((1 << GROUP_BITS) - 1), id_, [], [], []))
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), FREQUENT.types)], schema=FREQUENT)


def persisted(frame: DataFrame, name: str) -> DataFrame:
    """Written and read back in row groups of a bounded size, as rows hold long arrays."""
    path = scratch(frame.sparkSession, name)
    frame.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def frequent_words(relation: DataFrame, least: int, name: str) -> DataFrame:
    """The places of words that have ``least`` occurrences in all: ``chunk``, ``grp`` and the word's ``id``.

    A word's first row also has the word, its language and its occurrences (``f``). Words are
    counted, and the chunks' rows semi-joined with the frequent ones, in one exchange by
    word. A word has one row for each chunk.
    """
    rows = relation.select("chunk", "base", "lang", F.posexplode(F.arrays_zip("word", "count")).alias("nth", "row"))
    where = F.shiftleft("chunk", GROUP_BITS).bitwiseOR(F.col("base") + F.col("nth"))
    rows = rows.select("lang", "row.word", "row.count", where.alias("where")).repartition("lang", "word")
    counts = rows.groupBy("lang", "word").agg(F.sum("count").alias("f"), F.min("where").alias("id")).filter(F.col("f") >= least)
    found = rows.drop("count").join(counts, ["lang", "word"])
    own = F.col("where") == F.col("id")
    return persisted(
        found.select(
            F.shiftright("where", GROUP_BITS).alias("chunk"),
            F.col("where").bitwiseAND((1 << GROUP_BITS) - 1).alias("grp"),
            "id",
            *[F.when(own, F.col(c)).alias(c) for c in ("lang", "word", "f")],
        ),
        name,
    )


def frequent_groups(relation: DataFrame, least: int, of_chunks: bool, name: str) -> DataFrame:
    """Groups of two or more words that have ``least`` occurrences in all, and which ones each chunk has.

    Sections of one bucket come together from all chunks, where groups are counted and the
    chunks' groups semi-joined with the frequent ones. The number of buckets follows from the
    corpus, so a bucket is of bounded size, and a group has one entry for each chunk.
    """
    sections = relation.filter(F.size("first") > 0).select("bucket", "chunk", "base", "first", "last", "count")
    work = sections.groupBy("bucket").applyInArrow(lambda rows: counted(rows, least, of_chunks), FREQUENT_COLUMNS)
    return persisted(work, name)


def of_groups(frequent: DataFrame) -> DataFrame:
    """One row for each frequent group."""
    lists = frequent.filter("chunk is null").select(F.explode(F.arrays_zip("id", "first", "last", "f")).alias("row"))
    return lists.select("row.*")


def discarded(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more; what came of them is written too."""
    for table_ in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table_.inputFiles()}:
            store, path = opened(folder)
            store.delete_dir(path)


def extended(relation: DataFrame, frequent: DataFrame, buckets: int, name: str) -> DataFrame:
    """The relation of occurrences one word longer."""
    of_chunk = frequent.filter("chunk is not null").select("chunk", "grp", "id")
    mine = relation.filter("at is not null").select("chunk", "at", "grp")
    pairs = mine.groupBy("chunk").cogroup(of_chunk.groupBy("chunk"))
    return persisted(pairs.applyInArrow(lambda a, b: longer(a, b, buckets), RELATION_COLUMNS), name)


def described(groups: DataFrame, shorter: DataFrame, words: int) -> DataFrame:
    """Adds to groups of two or more words what they consist of, from those one word shorter.

    ``heads`` and ``tails`` have the occurrences of the first and last 1, 2, ... words, and
    ``inner`` the length and id of each contiguous phrase of two words or more inside.
    """
    first = shorter.select(
        F.col("id").alias("first"),
        "lang",
        F.col("phrase").alias("start"),
        F.concat("heads", F.array("f")).alias("heads"),
        F.col("inner").alias("inner_first"),
    )
    last = shorter.select(
        F.col("id").alias("last"),
        F.element_at(F.split("phrase", " "), -1).alias("word"),
        F.concat("tails", F.array("f")).alias("tails"),
        F.col("inner").alias("inner_last"),
    )
    own = F.array(*[F.struct(F.lit(words - 1).alias("words"), F.col(c).alias("id")) for c in ("first", "last")])
    inner = F.array_union("inner_first", "inner_last")
    return groups.join(first, "first").join(last, "last").select(
        "id",
        "lang",
        "f",
        F.concat_ws(" ", "start", "word").alias("phrase"),
        "heads",
        "tails",
        (F.array_union(own, inner) if words > 2 else inner).alias("inner"),
    )


def wide(count: Column) -> Column:
    return count.cast("decimal(19,0)")


def candidates(documents: DataFrame, text: str, lang: str, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """All phrases of 2 to ``longest`` words with ``least`` occurrences, and ``n`` words of each language."""
    relation = persisted(first_relation(documents, text, lang), "op11-words")
    totals = persisted(relation.groupBy("lang").agg(F.sum("n").alias("n")), "op11-totals")
    words_in_all = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(16, -(-words_in_all // BUCKET_WORDS))
    frequent = frequent_words(relation, least, "op11-frequent1")
    none = F.array().cast("array<long>")
    inner = F.array().cast("array<struct<words:int,id:bigint>>")
    words_ = frequent.filter("word is not null").select(
        "id", "lang", "f", F.col("word").alias("phrase"), none.alias("heads"), none.alias("tails"), inner.alias("inner")
    )
    last = persisted(words_, "op11-phrases1")
    found = []
    for words in range(2, longest + 1):
        before = (relation, frequent)
        relation = extended(relation, frequent, buckets, f"op11-relation{words}")
        discarded(*before)
        frequent = frequent_groups(relation, least, words < longest, f"op11-frequent{words}")
        last = persisted(described(of_groups(frequent), last, words).withColumn("words", F.lit(words)), f"op11-phrases{words}")
        found.append(last)
    discarded(relation, frequent)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, totals


def collocations(
    documents: DataFrame, text: str, lang: str, longest: int = LONGEST, least: int = LEAST, covered: int = COVERED, first: int = FIRST
) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Occurrences of words are a relation in chunks of one language, sorted by piece and place
    and written. A longer relation comes from merging one with itself where places are
    adjacent, after a semi-join with the groups frequent over all chunks; only groups, counted
    in their chunk, are shuffled, not occurrences. Counts are exact, since every part of a
    phrase occurs at least as often as the phrase.

    Null texts are empty, null languages are ``und``. Repeated rows count as often as they
    stand. Equal scores go by count, then by the phrase's UTF-8 bytes, so ranks have no ties.
    Without documents there are no rows.
    """
    every, totals = candidates(documents, text, lang, longest, least)
    inside = every.select(F.explode("inner").alias("part"), "f")
    holders = inside.groupBy(F.col("part.words").alias("words"), F.col("part.id").alias("id")).agg(F.max("f").alias("most"))
    kept = every.join(holders, ["words", "id"], "left").filter(
        F.col("most").isNull() | (wide(F.col("most")) * 100 < wide(F.col("f")) * covered)
    )
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("words") - 1),
        lambda k: F.struct(
            F.call_function(
                "div",
                wide(F.col("f")) * SCALE,
                wide(F.element_at("heads", k)) + wide(F.element_at("tails", F.col("words") - k)),
            ).alias("score"),
            k.alias("k"),
            F.element_at("heads", k).alias("l"),
            F.element_at("tails", F.col("words") - k).alias("r"),
        ),
    )
    scored = kept.withColumn("cut", F.array_min(cuts)).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= first)
    of_lang = totals.withColumnRenamed("lang", "_lang")
    return ranked.join(of_lang, F.col("lang") == F.col("_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents"), "text", "lang")
