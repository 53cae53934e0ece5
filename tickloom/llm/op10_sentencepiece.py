"""SentencePiece encoding and decoding by batched Viterbi in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import table
from tickloom.llm.words import Words, WordTable, encoded, hashes, mixed, slices, spread

UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
SPACE = "▁"
BATCH_CHARS = 1 << 18
_UNK_PENALTY = 10.0
_NEVER = np.int64(1) << 60
_B = np.uint64(0x9E3779B97F4A7C15)


def _char_keys(chars: np.ndarray) -> np.ndarray:
    return mixed(chars.astype(np.uint64) + np.uint64(0x1234567))


class Pieces:
    """The vocabulary of a model, with sorted keys of its pieces to probe.

    The key of a string is a polynomial of its characters' hashes, so the key of two joined
    strings follows from theirs. For a model of the BPE kind there are also the two parts
    that each piece is last merged from.
    """

    def __init__(self, path: str, kind: int | None = None):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as source:
            model.ParseFromString(source.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models whose normalizer leaves texts as they are can be used")
        if any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces):
            raise ValueError("a piece of this model spans words")
        self.kind = kind or model.trainer_spec.model_type
        self.names = [p.piece for p in model.pieces]
        self.kinds = np.array([p.type for p in model.pieces])
        self.scores = np.array([p.score for p in model.pieces])
        self.prefix = model.normalizer_spec.add_dummy_prefix
        self.unknown = int(np.flatnonzero(self.kinds == UNKNOWN)[0])
        self.bytes_of = np.full(256, self.unknown, np.int64)
        if model.trainer_spec.byte_fallback:
            for i in np.flatnonzero(self.kinds == BYTE):
                self.bytes_of[int(self.names[i][3:-1], 16)] = i
        size = len(self.names)
        words = np.flatnonzero((self.kinds == NORMAL) | (self.kinds == USER))
        self.chars = {int(i): [ord(c) for c in self.names[i]] for i in words}
        self.longest = max(map(len, self.chars.values()))
        # the last entry stands for a character that is no piece
        self.length = np.ones(size + 1, np.int64)
        self.key = np.zeros(size + 1, np.uint64)
        self.key[size] = np.uint64(0xDEADBEEFCAFE1234)
        self.power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(4 * self.longest, _B)]))
        for i, chars in self.chars.items():
            self.length[i] = len(chars)
        for n in range(1, self.longest + 1):
            own = words[self.length[words] == n]
            grid = np.array([self.chars[int(i)] for i in own]).reshape(len(own), n)
            self.key[own] = self._prefixes(grid)[:, -1]
        order = words[np.argsort(self.key[words])]
        self.sorted_keys, self.sorted_ids = self.key[order], order
        # a better score is a lower rank; single characters and what is no piece are never merged
        self.rank = np.full(size + 1, -1, np.int64)
        self.rank[:size] = np.unique(-self.scores, return_inverse=True)[1]
        self.rank[self.length == 1] = -1
        self.rank[size] = -1
        self.worst = float(self.scores[words].min()) - _UNK_PENALTY
        self.run, self.run_id = 0, -1
        if self.kind == BPE:
            self._split()
            self.run, self.run_id = self._space_run()
        texts = [self._raw(i) for i in range(size)]
        self.raw_length = np.array([len(t) for t in texts])
        self.raw_begin = np.cumsum(self.raw_length) - self.raw_length
        self.raw = np.frombuffer(b"".join(texts), np.uint8)

    def _raw(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.names[i][3:-1], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        return b" \xe2\x81\x87 " if self.kinds[i] == UNKNOWN else self.names[i].replace(SPACE, " ").encode()

    def _prefixes(self, grid: np.ndarray) -> np.ndarray:
        """Keys of all prefixes of rows of characters, the empty one first."""
        out = np.zeros((grid.shape[0], grid.shape[1] + 1), np.uint64)
        keys = _char_keys(grid)
        for i in range(grid.shape[1]):
            out[:, i + 1] = out[:, i] * _B + keys[:, i]
        return out

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these keys, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.sorted_keys, keys), len(self.sorted_keys) - 1)
        return np.where(self.sorted_keys[at] == keys, self.sorted_ids[at], -1)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ids of the pieces that two symbols side by side would merge to, -1 for none."""
        return self.probe(self.key[a] * self.power[self.length[b]] + self.key[b])

    def symbols(self, grid: np.ndarray) -> np.ndarray:
        found = self.probe(_char_keys(grid))
        return np.where(found < 0, len(self.names), found)

    def merge(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of rows of equally many characters by merging the best pair, the leftmost
        among equals, until none is left: rows padded with -1, and the last two merged."""
        row = self.symbols(grid)
        last = np.full((len(row), 2), -1, np.int64)
        live = np.arange(len(row))
        while len(live) and row.shape[1] > 1:
            part = row[live]
            ok = part[:, 1:] >= 0
            new = np.where(ok, self.joined(part[:, :-1], np.maximum(part[:, 1:], 0)), -1)
            new = np.where(part[:, :-1] >= 0, new, -1)
            cost = np.where(new >= 0, self.rank[new], _NEVER)
            at = cost.argmin(axis=1)
            some = cost[np.arange(len(at)), at] < _NEVER
            live, part, new, at = live[some], part[some], new[some], at[some]
            if not len(live):
                break
            own = np.arange(len(live))
            last[live] = np.stack([part[own, at], part[own, at + 1]], axis=1)
            shifted = np.concatenate([part[:, 1:], np.full((len(part), 1), -1)], axis=1)
            kept = np.where(np.arange(part.shape[1]) <= at[:, None], part, shifted)
            kept[own, at] = new[own, at]
            row[live] = kept
        return row, last

    def _split(self) -> None:
        """The parts of each piece; pieces that merging never makes can't be probed for words."""
        size = len(self.names)
        self.left, self.right = np.full(size + 1, -1, np.int64), np.full(size + 1, -1, np.int64)
        self.made = self.length == 1
        ids = np.array(list(self.chars))
        for n in range(2, self.longest + 1):
            own = ids[self.length[ids] == n]
            if not len(own):
                continue
            row, last = self.merge(np.array([self.chars[int(i)] for i in own]))
            fine = (row[:, 0] == own) & (row[:, 1] < 0)
            self.made[own] = fine
            self.left[own[fine]], self.right[own[fine]] = last[fine, 0], last[fine, 1]
        # pieces with a part of worse rank: when they were merged does not follow from ranks
        odd = np.zeros(size + 1, bool)
        for i in ids[np.argsort(self.length[ids], kind="stable")]:
            a, b = self.left[i], self.right[i]
            odd[i] = a >= 0 and (odd[a] or odd[b] or max(self.rank[a], self.rank[b]) >= self.rank[i])
        self.odd = odd

    def _space_run(self) -> tuple[int, int]:
        """Length and id of the longest piece of spaces if long runs begin with it; else 0 and -1.

        They do if pieces that begin with two spaces are all spaces and merge after all others, at
        one score: then the words are done first, and spaces are merged from the left, where what
        has come to the longest piece is final and leaves a shorter run. Tried on a whole period.
        """
        mark = ord(SPACE)
        runs = [i for i, c in self.chars.items() if c[:2] == [mark, mark]]
        others = [i for i, c in self.chars.items() if len(c) > 1 and c[:2] != [mark, mark]]
        if not runs or any(set(self.chars[i]) != {mark} for i in runs) or len(set(self.rank[runs])) > 1:
            return 0, -1
        if others and self.rank[others].max() >= self.rank[runs[0]]:
            return 0, -1
        best = max(runs, key=lambda i: len(self.chars[i]))
        m = len(self.chars[best])

        def merged(n: int) -> list[int]:
            ids = self.merge(np.full((1, n), mark))[0][0]
            return ids[ids >= 0].tolist()

        whole = all(merged(n + m) == [best, *merged(n)] for n in range(2 * m - 1, 3 * m))
        return (m, best) if whole else (0, -1)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps pieces a and b apart when they stand side by side.

        Merges are undone from the last one back; at each stage the two symbols at the border
        must not be a pair that merging would have taken before what comes next.
        """
        result = np.ones(len(a), bool)
        odd = self.odd[a] | self.odd[b]
        if odd.any():
            for i in np.flatnonzero(odd).tolist():
                result[i] = self._apart(int(a[i]), int(b[i]))
        live = np.flatnonzero(~odd)
        a, b = a[live], b[live]
        limit, inside_b = np.full(len(live), _NEVER), np.zeros(len(live), bool)
        while len(live):
            new = self.joined(a, b)
            cost = np.where(new >= 0, self.rank[new], _NEVER)
            bad = (cost < limit) | ((cost == limit) & inside_b & (cost < _NEVER))
            result[live[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            inside_b, live = ~undo_a[go], live[go]
        return result

    @lru_cache(maxsize=1 << 16)  # noqa: B019  one object for each worker process
    def _apart(self, a: int, b: int) -> bool:
        if a == len(self.names) or b == len(self.names):
            return True
        row, _ = self.merge(np.array([self.chars[a] + self.chars[b]]))
        return row[0, 0] == a and row[0, 1] == b and (row.shape[1] == 2 or row[0, 2] < 0)

    def viterbi(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best paths of rows of equally many characters.

        Returns for each place the piece that ends there on the best path to it, and how many
        characters it has. All rows advance together. Substring keys are probed for all places
        and lengths at once. For a unigram model the best path to a place has the largest sum
        of scores, the longer last piece among equals. For a BPE model a path counts if each
        two neighbouring pieces are compatible; there is one such path to every place, and it
        is the one that merging gives.
        """
        rows, n = grid.shape
        most = min(n, self.longest)
        prefix = self._prefixes(grid)
        piece = np.full((rows, n + 1), -1, np.int64)
        length = np.zeros((rows, n + 1), np.int64)
        best = np.zeros((rows, n + 1))
        ids = np.full((rows, n + 1, most + 1), -1, np.int64)
        for k in range(1, most + 1):
            ids[:, k:, k] = self.probe(prefix[:, k:] - prefix[:, : n + 1 - k] * self.power[k])
        ids[:, 1:, 1] = np.where(ids[:, 1:, 1] < 0, len(self.names), ids[:, 1:, 1])
        if self.kind == BPE:
            ids = np.where(self.made[ids] & (ids >= 0), ids, -1)
        for i in range(1, n + 1):
            row, k = np.nonzero(ids[:, i, :] >= 0)
            new = ids[row, i, k]
            value = np.zeros(len(row))
            if self.kind == BPE:
                inner = np.flatnonzero(k < i)
                value[inner] = np.where(self.compatible(piece[row[inner], i - k[inner]], new[inner]), 0, -np.inf)
            else:
                value = best[row, i - k] + np.append(self.scores, self.worst)[new]
            # rows come in order, with rising lengths: the last of the largest of each row
            table_ = np.full((rows, most + 1), -np.inf)
            table_[row, k] = value
            pick = most - table_[:, ::-1].argmax(axis=1)
            best[:, i] = table_[np.arange(rows), pick]
            length[:, i] = pick
            piece[:, i] = ids[np.arange(rows), i, pick]
        return piece, length

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units end to end, and the number for each. Units of one length go together."""
        texts = [u.decode("utf-8", "replace").replace(" ", SPACE) for u in units]
        heads: dict[int, int] = {}  # pieces that long runs of spaces begin with
        if self.run:
            long = SPACE * (4 * self.run)
            for i, t in enumerate(texts):
                if t.startswith(long):
                    heads[i] = (len(t) - len(t.lstrip(SPACE))) // self.run - 2
                    texts[i] = t[heads[i] * self.run :]
        by: dict[tuple[int, bool], list[int]] = {}
        for i, t in enumerate(texts):
            by.setdefault((len(t), t.startswith(SPACE * 2)), []).append(i)
        found: list[np.ndarray | None] = [None] * len(units)
        for (n, spaces), members in by.items():
            if not n:
                continue
            step = max(1, BATCH_CHARS // (n * 8))
            for begin in range(0, len(members), step):
                part = members[begin : begin + step]
                flat = np.frombuffer("".join([texts[i] for i in part]).encode("utf-32-le"), "<u4")
                grid = flat.reshape(len(part), n).astype(np.int64)
                # runs of spaces are merged at one score, so their order is not that of ranks
                if spaces and self.kind == BPE:
                    ids, _ = self.merge(grid)
                    take = ids >= 0
                    ends = np.where(take, self.length[ids], 0).cumsum(axis=1)
                else:
                    ids, take, ends = self._path(*self.viterbi(grid))
                self._emit(part, texts, ids, take, ends, found)
        for i, n in heads.items():
            found[i] = np.concatenate([np.full(n, self.run_id), found[i]])
        none = np.zeros(0, np.int64)
        done = [none if x is None else x for x in found]
        return np.concatenate([none, *done]).astype(np.uint32), np.array([len(x) for x in done], np.int64)

    def _path(self, piece: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Follows the backpointers of all rows from their ends."""
        rows, n = piece.shape
        take = np.zeros((rows, n), bool)
        at, own = np.full(rows, n - 1), np.arange(rows)
        while len(own):
            take[own, at] = True
            at = at - length[own, at]
            own, at = own[at > 0], at[at > 0]
        return piece, take, np.broadcast_to(np.arange(n), (rows, n))

    def _emit(self, part, texts, ids, take, ends, found) -> None:
        row, col = np.nonzero(take)
        got, stop = ids[row, col], ends[row, col]
        cut = np.searchsorted(row, np.arange(1, len(part)))
        strange = got == len(self.names)
        has = np.zeros(len(part), bool)
        has[row[strange]] = True
        for j, (i, x) in enumerate(zip(part, np.split(got, cut))):
            if has[j]:
                begin = int(cut[j - 1]) if j else 0
                out: list[int] = []
                for p, e in zip(x.tolist(), stop[begin : begin + len(x)].tolist()):
                    raw = texts[i][e - 1].encode() if p == len(self.names) else b""
                    out += self.bytes_of[np.frombuffer(raw, np.uint8)].tolist() if raw else [p]
                x = np.array(out)
            found[i] = x

    def decode(self, ids: np.ndarray, count: np.ndarray) -> list[bytes]:
        """Texts of ids that lie end to end, without the space put before each text."""
        lengths = self.raw_length[ids]
        data = self.raw[spread(self.raw_begin[ids], lengths)].tobytes()
        stops = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(count)])].tolist()
        out = []
        for a, b in zip(stops[:-1], stops[1:]):
            out.append(data[a + 1 : b] if self.prefix and data[a : a + 1] == b" " else data[a:b])
        return out


_SPACE_BYTE, _LINE = 32, 10


def units_of(texts: list[bytes], prefix: bool) -> Words:
    """Units that no piece spans: spaces with what follows them up to the next space, and line ends."""
    mark = SPACE.encode()
    prepared = [(b" " if prefix and t else b"") + (t.replace(mark, b" ") if mark in t else t) for t in texts]
    lengths = np.fromiter(map(len, prepared), np.int64, len(prepared))
    data = np.frombuffer(b"".join(prepared), np.uint8)
    first = np.cumsum(lengths) - lengths
    begin = np.zeros(len(data) + 1, bool)
    begin[first] = True
    space, line = data == _SPACE_BYTE, data == _LINE
    begin[1:-1] |= (space[1:] & ~space[:-1]) | line[1:] | line[:-1]
    begin[len(data)] = False
    start = np.flatnonzero(begin)
    end = np.append(start[1:], len(data))
    if not len(start):
        end = start
    hashed = hashes(data, start, end)
    offsets = np.append(np.searchsorted(start, first), len(start))
    return Words(data, start, end, hashed, offsets)


@lru_cache(maxsize=2)
def pieces(path: str, kind: int | None = None) -> tuple[Pieces, WordTable]:
    """The vocabulary and the table of units met by this worker process."""
    found = Pieces(path, kind)
    return found, WordTable(found.encode_units, np.uint32)


def encode_batch(texts: list[bytes], model: Pieces, units: WordTable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of slices of texts end to end, and the number for each text."""
    for begin, end in slices(texts):
        yield units.of(units_of(texts[begin:end], model.prefix))


def encode_documents(documents: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """Adds to the key the ids of whole texts (``ids``) and the text decoded from them.

    A null text counts as empty and has no ids. The mark for spaces, where a text has it,
    decodes to a space.
    """
    schema = documents.select(key).schema.simpleString()[7:-1]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, units = pieces(path)
        for frame in batches:
            texts, at = encoded(frame[text]), 0
            for ids, count in encode_batch(texts, model, units):
                back = model.decode(ids, count)
                rows = np.split(ids.astype(np.int32), np.cumsum(count)[:-1])
                keys = frame[key].iloc[at : at + len(count)]
                at += len(count)
                yield pd.DataFrame(
                    {key: keys.to_numpy(), "ids": rows, "decoded": [b.decode("utf-8", "replace") for b in back]}
                )

    return documents.select(F.col(key), F.col(text)).mapInPandas(work, f"{schema}, ids array<int>, decoded string")


def op10_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Ids of all documents, and whether the ids decode to the text they came from."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary, units = pieces(path)
        for frame in batches:
            texts, at = encoded(frame["text"]), 0
            for ids, count in encode_batch(texts, vocabulary, units):
                back = vocabulary.decode(ids, count)
                part = texts[at : at + len(count)]
                raw, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(count)).tolist()
                out = pd.DataFrame({"doc_id": frame["doc_id"].to_numpy()[at : at + len(count)]})
                at += len(count)
                out["n_pieces"] = count
                out["ids_crc32"] = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
                out["decoded_crc32"] = list(map(zlib.crc32, back))
                out["same"] = [a == b for a, b in zip(part, back, strict=True)]
                yield out

    return documents.mapInPandas(
        work, "doc_id long, n_pieces long, ids_crc32 long, decoded_crc32 long, same boolean"
    )
