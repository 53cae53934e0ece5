"""Trees by hand, and manifests against a plain recomputation."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from tickloom.llm import op12_merkle as m

SMALL = "/root/testdata/sf0.001"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def plain_leaf(values) -> str:
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(digests: list[str]) -> tuple[str, list[list[str]]]:
    """The top, and each one's siblings from the lowest level on."""
    paths: list[list[str]] = [[] for _ in digests]
    at, row = list(range(len(digests))), list(digests)
    while len(row) > 1:
        for i, place in enumerate(at):
            first = place - place % 3
            paths[i].append((row[first:place], row[place + 1 : first + 3]))
            at[i] = place // 3
        row = [h(*row[i : i + 3]) for i in range(0, len(row), 3)]
    return row[0], paths


def plain(rows) -> list[tuple]:
    """What the manifest of these rows (doc_id, source, lang, n_chars, text) is, one row for each."""
    groups: dict = {}
    for r in rows:
        text = r[4]
        if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        groups.setdefault(r[1], []).append((r[0], plain_leaf(r), plain_leaf((*r[:4], text))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        leaves = sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees.append((leaves, *climb([x[1] for x in leaves])))
    if not trees:
        return []
    root, outer = climb([t[1] for t in trees])
    out = []
    for (leaves, subroot, paths), up in zip(trees, outer, strict=True):
        for (key, mine, changed), path in zip(leaves, paths, strict=True):
            folded = changed
            for left, right in path + up:
                folded = h(*left, folded, *right)
            proof = h(*[d for left, right in path + up for d in left + right])
            out.append((key, mine, subroot, root, proof, folded, folded == root))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:])))


def of_frame(frame, levels=m.LEVELS):
    made = m.manifest(frame, "doc_id", "source", m.FIELDS, "text", levels)
    return ordered(
        (r.doc_id, r.leaf, r.subroot, r.root, h(*r.proof), r.folded_root, r.folded_root == r.root) for r in made.collect()
    )


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("size, levels", [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (9, 2), (10, 3), (27, 3), (28, 4)])
def test_height(size, levels):
    assert m.height(size) == levels


def test_two_leaves_by_hand(spark):
    rows = [(2, "a", None, 3, "x\ny"), (1, "a", "en", 1, "é")]
    one, two = h("1:1", "1:a", "2:en", "1:1", "2:é"), h("1:2", "1:a", "-", "1:3", "3:x\ny")
    got = of_frame(spark.createDataFrame(rows, SCHEMA))
    assert [r[1] for r in got] == [one, two]
    assert {r[3] for r in got} == {h(one, two)} and {r[2] for r in got} == {h(one, two)}
    assert got[0][4] == h(two) and got == ordered(plain(rows))


def test_layers_of_small_superblocks(spark):
    rows = [(i * 7 % 61, f"s{min(i % 5, 2)}", "en", i, f"line {i}\nline {i * i}") for i in range(61)]
    rows += [(100 + i, f"t{i:02}", None, None, None if i % 2 else "\n") for i in range(12)]
    assert of_frame(spark.createDataFrame(rows, SCHEMA), 1) == ordered(plain(rows))


def test_nulls_repeats_long_texts_and_clashing_names(spark):
    rows = [(None, None, None, None, None), (5, None, "en", 2, "a\n"), (5, None, "en", 2, "a\n"), (5, None, "en", 2, "b\n")]
    rows += [(6, "", "", 0, ""), (7, "s", "fr", -3, "word\n" * 200_000), (7, "s", None, -3, None), (8, "S", "x", 1, "é \n")]
    frame = spark.createDataFrame(rows, SCHEMA)
    extra = {c: frame["text"] for c in ("tree", "place", "size", "digest", "key", "_rank", "left", "block")}
    want = ordered(plain(rows))
    assert of_frame(frame) == want
    assert of_frame(frame.withColumns(extra)) == want


def test_empty_and_single(spark):
    assert of_frame(spark.createDataFrame([], SCHEMA)) == []
    rows = [(1, "a", "en", 1, "x\n")]
    assert of_frame(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    assert plain(rows)[0][4] == h()


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(*m.FIELDS).collect()
    got = m.op12_merkle(spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [tuple(r) for r in got.collect()]
    assert ordered(rows) == ordered(plain([tuple(d) for d in docs]))
    assert {r[6] for r in rows} == {True, False}
