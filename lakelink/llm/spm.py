"""SentencePiece encoding and decoding by batched Viterbi in numpy.

A text gets the dummy prefix and its spaces become U+2581; it is cut before each run of U+2581, across which no piece
reaches. Distinct words of equal length advance together, one position at a time: the hashes of the substrings that
begin there, as long as some piece begins so, probe the sorted hashes of the pieces, transitions between the piece before and the piece found get a score,
and a vectorised maximum stores the backpointers.

Scores follow the model's type. In a unigram model a path's score is the sum of its pieces' scores. In a BPE model it is
minus infinity where merging the two pieces' characters would not give back just these two pieces and 0 elsewhere: exactly
one path per prefix survives, which is what merging gives, so ids equal those of the reference implementation.
Characters that are no piece become byte pieces where the model has them, the unknown piece elsewhere.

Rows: null text has null ids; an empty text has none. Decoding inverts encoding unless the text holds U+2581 itself or
has an unknown character in a model without byte pieces; `round_trip` says so for each row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute  # as pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wordhash import held, mix, powers, span_hash, tidy

SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Longer words go piece by piece, not in the batch.
LONG = 64
#: Words kept with their ids in one process.
KEPT = 400_000


class Pieces:
    """A model's pieces. kind: 'bpe' or 'unigram'."""

    def __init__(self, pieces: list[str], scores: list[float], kind: str, unknown: int, special: frozenset[int], byte_ids: dict[int, int]):
        self.pieces, self.scores, self.kind, self.unknown, self.bytes = pieces, scores, kind, unknown, byte_ids
        self.id = {p: i for i, p in enumerate(pieces) if i not in special and p}
        self.byte_of = {i: b for b, i in byte_ids.items()}
        self.special = special

    @classmethod
    def load(cls, model_file: str) -> Pieces:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = p.get_piece_size()
        names = [p.id_to_piece(i) for i in range(n)]
        byte_ids = {int(names[i][3:5], 16): i for i in range(n) if p.is_byte(i)}
        special = frozenset(i for i in range(n) if p.is_control(i) or p.is_unknown(i) or p.is_unused(i) or p.is_byte(i))
        scores = [p.get_score(i) for i in range(n)]
        ranked = [s for i, s in enumerate(scores) if i not in special]
        bpe = all(s == int(s) for s in ranked)  # merges are numbered in BPE models
        return cls(names, scores, "bpe" if bpe else "unigram", p.unk_id(), special, byte_ids)


class Encoder:
    def __init__(self, pieces: Pieces):
        self.p = pieces
        names = list(pieces.id)
        ids = np.array([pieces.id[x] for x in names], np.int64)
        codes = np.frombuffer("".join(names).encode("utf-32-le"), np.uint32)
        size = np.array([len(x) for x in names], np.int64)
        ends = np.cumsum(size)
        keys = self.hashes(codes, ends - size, ends)
        order = np.argsort(keys)
        self.keys, self.ids, self.longest = keys[order], ids[order], int(size.max())
        assert len(np.unique(keys)) == len(keys), "two pieces share a hash"
        self.score = np.array(pieces.scores)
        self.n = len(pieces.pieces) + 1  # one more stands for a character that is no piece
        self.edges = [self.chains(x) for x in pieces.pieces] if pieces.kind == "bpe" else []
        self.made = np.array([i not in pieces.special and bool(e) for i, e in enumerate(self.edges)] + [True]) if self.edges else np.ones(self.n, bool)
        self.slot_key, self.slot_ok = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)  # pairs judged last, by hash
        self.known: dict[int, bool] = {}
        heads = sorted({x[:k] for x in names for k in range(1, len(x) + 1)})
        codes, size = np.frombuffer("".join(heads).encode("utf-32-le"), np.uint32), np.array([len(x) for x in heads])
        ends = np.cumsum(size)
        self.begins = np.zeros(1 << 20, bool)  # by the top bits of a hash: whether any piece may begin so
        self.begins[(self.hashes(codes, ends - size, ends) >> np.uint64(44)).astype(np.int64)] = True
        self.spells = pa.array([bytes([self.p.byte_of[i]]) if i in self.p.byte_of else b"" if i in pieces.special else x.replace(SPACE, " ").encode("utf-8", "surrogatepass") for i, x in enumerate(pieces.pieces)], pa.binary())
        self.spelled_size = np.diff(np.frombuffer(self.spells.buffers()[1], np.int32)[: self.n]).astype(np.int64)
        self.forget()

    @staticmethod
    def hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return span_hash(codes, starts, ends)

    def merged(self, text: str) -> list[int]:
        """Ids of a short text by merging the best pair again and again."""
        own, parts = self.p.id, list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = own.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.p.scores[k] > best):
                    best, at = self.p.scores[k], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [own.get(x, self.n - 1) for x in parts]

    def chains(self, piece: str) -> tuple[list, list]:
        """What stands at a piece's left and right edge while merging makes it, each with the rank at which the next takes its place; empty if merging does not make it."""
        own, parts = self.p.id, list(piece)
        left, right = [], []
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                k = own.get(parts[i] + parts[i + 1])
                if k is not None and (best is None or self.p.scores[k] > best):
                    best, at = self.p.scores[k], i
            if at < 0:
                return ()
            if at == 0:
                left.append((parts[0], -best))
            if at == len(parts) - 2:
                right.append((parts[-1], -best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [*left, (piece, np.inf)], [*right, (piece, np.inf)]

    def stands(self, x: int, y: int) -> bool:
        """Whether merging the characters of pieces x and y gives x and y: no merge across their border comes first. Equal ranks go to the left."""
        if x == self.n - 1 or y == self.n - 1:
            return True
        if not self.edges[x] or not self.edges[y]:
            return False
        a, b = self.edges[x][1], self.edges[y][0]
        own, scores = self.p.id, self.p.scores
        i = j = 0
        while True:
            (r, until_r), (l, until_l) = a[i], b[j]
            k = own.get(r + l)
            if k is not None and -scores[k] < until_r and -scores[k] <= until_l:
                return False
            if until_r == until_l == np.inf:
                return True
            if until_r <= until_l:
                i += 1
            else:
                j += 1

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece b may stand after piece a."""
        if self.p.kind != "bpe":
            return np.ones(len(a), bool)
        key = a * self.n + b
        slot = (mix(key.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)
        new = self.slot_key[slot] != key
        ok = self.slot_ok[slot]
        if new.any():
            keys, back = np.unique(key[new], return_inverse=True)
            known = self.known
            for k in keys.tolist():
                if k not in known:
                    known[k] = self.stands(*divmod(k, self.n))
            found = np.array([known[k] for k in keys.tolist()])
            ok[new] = found[back]
            self.slot_key[slot[new]], self.slot_ok[slot[new]] = key[new], found[back]
            if len(known) > KEPT * 4:
                known.clear()
        return ok

    def batch(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and all ids, of words of one length."""
        n, size = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size)
        up, down = powers(max(size, 64) + 1)
        total = np.zeros((n, size + 1), np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:size], axis=1, out=total[:, 1:])
        last = np.full((n, size + 1), -1, np.int64)
        back = np.zeros((n, size + 1), np.int64)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        alive = np.zeros((n, size + 1), bool)
        alive[:, 0] = True
        for i in range(size):
            rows = np.flatnonzero(alive[:, i])
            for length in range(1, min(size - i, self.longest) + 1):
                j = i + length
                h = mix((total[rows, j] - total[rows, i]) * down[i] + np.uint64(length))
                on = self.begins[(h >> np.uint64(44)).astype(np.int64)]
                if length == 1:
                    found, code = rows, h
                    rows = rows[on]
                else:
                    rows, code = rows[on], h[on]
                    found = rows
                if not len(found):
                    break
                at = np.searchsorted(self.keys, code)
                at[at == len(self.keys)] = 0
                hit = self.keys[at] == code
                if length == 1:
                    t = np.where(hit, self.ids[at], self.n - 1)
                else:
                    found, t = found[hit], self.ids[at[hit]]
                good = self.fits(last[found, i], t) if i else self.made[t]
                found, t = found[good], t[good]
                value = best[found, i] + self.weight(t)
                better = value > best[found, j]
                found, t, value = found[better], t[better], value[better]
                best[found, j], last[found, j], back[found, j] = value, t, i
                alive[found, j] = True
        cur, steps = np.full(n, size), []
        row = np.arange(n)
        while cur.any():
            steps.append(np.where(cur > 0, last[row, cur], -1))
            cur = back[row, cur]  # back[:, 0] is 0
        tokens = np.stack(steps[::-1])
        odd = (tokens == self.n - 1).any(0)
        used = tokens >= 0
        count = used.sum(0)
        flat = tokens.T[used.T]
        if odd.any():
            parts: list[int] = []
            others, size_of = flat[np.repeat(~odd, count)], count.copy()
            for r in np.flatnonzero(odd).tolist():
                before, i = len(parts), 0
                for t in tokens[:, r][used[:, r]].tolist():
                    j = i + 1 if t == self.n - 1 else i + len(self.p.pieces[t])
                    parts += self.spelled(words[r][i:j]) if t == self.n - 1 else [t]
                    i = j
                size_of[r] = len(parts) - before
            count, flat = size_of, np.zeros(int(size_of.sum()), np.int64)
            own = np.repeat(odd, count)
            flat[own], flat[~own] = parts, others
        return count, flat

    def weight(self, t: np.ndarray) -> np.ndarray | float:
        if self.p.kind == "bpe":
            return 0.0
        low = self.score.min() - 10
        return np.where(t == self.n - 1, low, self.score[np.minimum(t, self.n - 2)])

    def spelled(self, ch: str) -> list[int]:
        if not self.p.bytes:
            return [self.p.unknown]
        return [self.p.bytes[b] for b in ch.encode("utf-8", "surrogatepass")]

    def alone(self, word: str) -> list[int]:
        """The same search for one long word, with a Python loop."""
        own, none = self.p.id, self.n - 1
        last, back, best = [-1] * (len(word) + 1), [0] * (len(word) + 1), [0.0] + [-np.inf] * len(word)
        for j in range(1, len(word) + 1):
            for length in range(1, min(j, self.longest) + 1):
                i = j - length
                t = own.get(word[i:j], none if length == 1 else -1)
                if t < 0 or best[i] == -np.inf or not i and not self.made[t] or i and not self.fits(np.array([last[i]]), np.array([t]))[0]:
                    continue
                value = best[i] + float(np.max(self.weight(np.array([t]))))
                if value > best[j]:
                    best[j], last[j], back[j] = value, t, i
        out: list[list[int]] = []
        j = len(word)
        while j:
            out.append(self.spelled(word[back[j] : j]) if last[j] == none else [last[j]])
            j = back[j]
        return [x for part in reversed(out) for x in part]

    def runs(self, word: str) -> list[int]:
        """Words with several U+2581: their merges have equal rank, so the leftmost goes first."""
        if self.p.kind != "bpe":
            return self.alone(word)
        lead = len(word) - len(word.lstrip(SPACE))
        if lead <= 256:
            return [x for part in self.split_merge(word) for x in part]
        return self.alone(word)

    def split_merge(self, word: str) -> list[list[int]]:
        lead = len(word) - len(word.lstrip(SPACE))
        if lead == len(word):
            return [self.merged(word)]
        rest = self.alone(word[lead - 1 :])
        if rest and rest[0] == self.p.id.get(SPACE):  # the word leaves its U+2581 to the run
            return [self.merged(SPACE * lead), rest[1:]]
        return [self.merged(SPACE * (lead - 1)), rest]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids begin in `kept`, and how many there are."""
        by: dict[int, list[int]] = {}
        begin, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for k, w in enumerate(words):
            if w[:2] == SPACE * 2 or len(w) > LONG:
                ids = self.runs(w) if w[:2] == SPACE * 2 else self.alone(w)
                begin[k], count[k] = self.keep(np.array(ids, np.int32)), len(ids)
            else:
                by.setdefault(len(w), []).append(k)
        for _, at in sorted(by.items()):
            for i in range(0, len(at), 20_000):
                part = at[i : i + 20_000]
                n, flat = self.batch([words[x] for x in part])
                begin[part], count[part] = self.keep(flat.astype(np.int32)) + np.cumsum(n) - n, n
        return begin, count

    def keep(self, ids: np.ndarray) -> int:
        """Append ids to `kept`; where they begin."""
        first, need = self.used, self.used + len(ids)
        if need > len(self.kept):
            self.kept = np.concatenate([self.kept, np.zeros(max(need, 1 << 16), np.int32)])
        self.kept[first:need] = ids
        self.used = need
        return first

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        if len(self.cache) > KEPT:
            self.forget()
        cache, at, count = self.cache, [], []
        old = len(cache)
        for t in texts:
            cut = _WORD.findall(SPACE + t.replace(" ", SPACE)) if t else []
            count.append(len(cut))
            at += [cache.setdefault(w, len(cache)) for w in cut]
        fresh = list(islice(cache, old, None))
        begin, size = self.words(fresh)
        self.begin, self.size = np.concatenate([self.begin, begin]), np.concatenate([self.size, size])
        use = np.array(at, np.int64)
        per = self.size[use]
        ends = np.cumsum(per)
        total = int(ends[-1]) if len(ends) else 0
        where = np.repeat(self.begin[use] - (ends - per), per) + np.arange(total)
        word_ends = np.concatenate([[0], ends]).astype(np.int64)
        off = word_ends[np.concatenate([[0], np.cumsum(count)]).astype(np.int64)]
        values = self.kept[where] if total else np.zeros(0, np.int32)
        mask = np.array([t is None for t in texts] + [False])
        return pa.ListArray.from_arrays(pa.array(off.astype(np.int32), mask=mask) if mask.any() else pa.array(off.astype(np.int32)), pa.array(values))

    def forget(self) -> None:
        self.cache: dict[str, int] = {}
        self.kept, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def restores(self, texts: list[str | None], ids: pa.ListArray) -> list[bool]:
        """Whether the ids of each text spell it, byte for byte."""
        flat = ids.values
        size = np.concatenate([[0], np.cumsum(self.spelled_size[flat.to_numpy()])])
        at = size[np.frombuffer(ids.buffers()[1], np.int32)[: len(texts) + 1]].tolist()
        raw = memoryview(pa.compute.take(self.spells, flat).buffers()[2] or b"").cast("B")  # Arrow says signed bytes
        # the dummy prefix is the first byte
        return [t is None or raw[a + (a < b and raw[a] == 32) : b] == t.encode("utf-8", "surrogatepass") for t, a, b in zip(texts, at, at[1:])]

    def decode(self, ids: list[int] | None) -> str | None:
        if ids is None:
            return None
        p, byte_of = self.p, self.p.byte_of
        if byte_of.keys().isdisjoint(ids):
            whole = "".join([p.pieces[i] for i in ids if i not in p.special])
        else:
            raw = bytearray()
            for i in ids:
                if i in byte_of:
                    raw.append(byte_of[i])
                elif i not in p.special:
                    raw += p.pieces[i].encode("utf-8", "surrogatepass")
            whole = raw.decode("utf-8", "replace")
        whole = whole.replace(SPACE, " ")
        return whole[1:] if whole[:1] == " " else whole


def _encoder(shared) -> Encoder:
    if id(shared) not in held:
        held.clear()
        held[id(shared)] = shared, Encoder(shared.value)
    return held[id(shared)][1]


def encode(docs: DataFrame, model_file: str, text_col: str = "text", *, out: str = "ids", rows_at_once: int = 1500) -> DataFrame:
    """docs with `out` (array<int>), n_tokens and round_trip (whether decoding gives the text again).

    model_file is read on the driver; its pieces (tens of thousands) are broadcast.
    """
    names = [out, "n_tokens", "round_trip"]
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"docs has columns {sorted(clash)} already")
    shared = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_file))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.IntegerType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(shared)
        for batch in batches:
            for i in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(i, rows_at_once)
                texts = part.column(text_col).to_pylist()
                ids = e.encode(texts)
                same = e.restores(texts, ids)
                yield pa.RecordBatch.from_arrays([*part.columns, ids, pa.compute.list_value_length(ids), pa.array(same, pa.bool_())], [*part.schema.names, *names])

    return docs.mapInArrow(tidy(run, shared), schema)


def decode(rows: DataFrame, model_file: str, ids_col: str = "ids", *, out: str = "decoded") -> DataFrame:
    """rows with `out`, the text of ids_col; null ids give null."""
    shared = rows.sparkSession.sparkContext.broadcast(Pieces.load(model_file))
    schema = T.StructType([*rows.schema.fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = _encoder(shared)
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([e.decode(x) for x in b.column(ids_col).to_pylist()], pa.string())], [*b.schema.names, out])

    return rows.mapInArrow(tidy(run, shared), schema)
