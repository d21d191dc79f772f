"""Alignment of two tokenizers' token sequences over the same bytes.

Tokenizer A reads a space and the text, tokenizer B the text (it adds the space
itself), so the tokens of both spell the same bytes.  Two tokens are linked if
their byte ranges overlap; a group ends at each byte offset where a token of
either side ends.

*Encoding.*  A text is cut where no token reaches across: before a run of spaces
that follows another character.  No piece of B's vocabulary spans such a place
(checked when it is read), and A's split pattern never does unless the character
before is white space too; segments with such a place are encoded whole by A.
What a part becomes is remembered in a bounded table.

*Merge path.*  The ends of A and of B are two sorted lists.  The split of the
first d ends of their merged order, for d = ``piece``, 2 ``piece`` ..., is found
by binary search along the diagonal i + j = d, for all diagonals at once; on a
tie A's end comes first.  So a document becomes independent pieces of equal
work.  A piece carries the bytes that its first tokens start at and the next
token of either side; with these it finds all links of its ends by itself: each
end makes one link, of the tokens of both sides that hold the byte before it,
and an end that both sides have makes one for both.  The piece in which the
later of two equal ends stands closes the group.

*Counts.*  Links are counted by id pair, summed in the task and before the
shuffle.  The most frequent pairs (``known_pairs`` at most) and the highest
count of each B id (bounded by the vocabulary) go to every task; what a document
links by rarer pairs is joined with their counts.

*Stitching.*  Documents of one piece are whole in their row.  Of the others the
pieces' open first and last groups are stitched in the order of the pieces by a
pass over sorted rows, which holds one piece at a time.

Defined results: one row for each row of the table, whatever its key; a text
that is null, empty, or whose tokens do not spell it has no tokens: zeros and
an empty digest; repeated rows count each; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch_folder

#: Parts that a side remembers, and how long they may be.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 48
#: Characters of a segment and of texts that are encoded together, and tokens that are aligned at a time.
SEGMENT, TOGETHER, TOKENS = 1 << 20, 1 << 18, 1 << 20
#: Rows of different documents are this many bytes apart in the merged order of a batch.
APART = 1 << 40


@dataclass(frozen=True)
class AlignRule:
    piece: int = 1 << 16
    known_pairs: int = 500_000
    #: Distinct pairs that a counting task holds before it passes them on.
    held_pairs: int = 1_000_000


# ---------------------------------------------------------------- tokenizers


def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes for 256 and up in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def packed(ids: list[int], entries: list[bytes], part: str) -> bytes | None:
    """Ids as 32-bit integers; None if their tokens do not spell the part."""
    spelt = b"".join([entries[i] for i in ids]) == part.encode()
    return array("i", ids).tobytes() if spelt else None


@dataclass
class ByteLevel:
    """A byte-level BPE vocabulary (``tokenizers`` JSON), read on the driver and built again in each task."""

    source: str = field(repr=False)
    pattern: str
    entries: list[bytes] = field(repr=False)

    @classmethod
    def read(cls, path: str, pattern: str) -> ByteLevel:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            source = file.read()
        tokenizer, byte = Tokenizer.from_str(source), byte_of_character()
        special = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
        entries = [b""] * tokenizer.get_vocab_size()
        for token, i in tokenizer.get_vocab().items():
            entries[i] = special[i] if i in special else bytes(byte[c] for c in token)
        return cls(source, pattern, entries)

    def encoder(self) -> Callable[[str], bytes | None]:
        """Packed ids of any text, pre-token by pre-token."""
        from tokenizers import Tokenizer

        model, split = Tokenizer.from_str(self.source).model, regex.compile(self.pattern).findall
        character = {b: c for c, b in byte_of_character().items()}
        spell = {b: character[b] for b in range(256)}  # of a byte, read as Latin-1
        known: dict[str, bytes | None] = {}

        def encode(part: str) -> bytes | None:
            words = split(part)
            new = [w for w in words if w not in known]
            if new:
                if len(known) >= CACHE_ENTRIES:
                    known.clear()
                    new = words
                for word in new:
                    ids = [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(spell))]
                    known[word] = packed(ids, self.entries, word)
            try:
                return b"".join(map(known.__getitem__, words))
            except TypeError:  # a None among them
                return None

        return encode


@dataclass
class Pieces:
    """A sentencepiece model with byte fallback, read on the driver and built again in each task."""

    source: bytes = field(repr=False)
    entries: list[bytes] = field(repr=False)

    @classmethod
    def read(cls, path: str) -> Pieces:
        from sentencepiece import SentencePieceProcessor

        with open(path, "rb") as file:
            source = file.read()
        model = SentencePieceProcessor(model_proto=source)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece reaches across a space: texts can't be cut there")
        one = re.compile("<0x([0-9A-Fa-f]{2})>")
        entries = [bytes([int(m[1], 16)]) if (m := one.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        return cls(source, entries)

    def encoder(self) -> Callable[[list[str]], list[bytes | None]]:
        """Packed ids of texts that begin with the space which the model adds itself."""
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_proto=self.source)
        # by itself, an empty text would not get that space
        space = model.encode_as_ids("a ")[len(model.encode_as_ids("a")) :]

        def encode(parts: list[str]) -> list[bytes | None]:
            found = model.encode_as_ids([p[1:] for p in parts])
            return [packed(space if p == " " else ids, self.entries, p) for p, ids in zip(parts, found, strict=True)]

        return encode


#: A run of spaces and what follows it.  No token of B reaches across the start of one, and none of
#: A does where the character before is no white space of another kind.
split_parts = re.compile(" +[^ ]*").findall
other_space = re.compile(r"[^\S ] ").search


class Parts:
    """Packed ids of parts of texts, by side; None where the tokens do not spell the part."""

    def __init__(self, a: ByteLevel, b: Pieces) -> None:
        self.encode_a, self.encode_b = a.encoder(), b.encoder()
        self.known: tuple[dict[str, bytes | None], dict[str, bytes | None]] = ({}, {})

    def ids(self, segment_lists: list[list[str]]) -> list[list[np.ndarray]]:
        """The ids of both sides of texts given as their segments; none where a text isn't spelt."""
        texts = [[split_parts(s) for s in segments_] for segments_ in segment_lists]
        wanted = set().union(*(parts for lists in texts for parts in lists))
        a, b = self.known
        if len(a) + len(wanted) > CACHE_ENTRIES:
            a.clear()
            b.clear()
        new = list(wanted.difference(a))
        a.update(zip(new, map(self.encode_a, new), strict=True))
        b.update(zip(new, self.encode_b(new), strict=True))
        out = []
        for segments_, lists in zip(segment_lists, texts, strict=True):
            try:
                sides = [
                    b"".join(
                        self.encode_a(s) if other_space(s) else b"".join(map(a.__getitem__, parts))
                        for s, parts in zip(segments_, lists, strict=True)
                    ),
                    b"".join([b"".join(map(b.__getitem__, parts)) for parts in lists]),
                ]
            except TypeError:  # a None among them
                sides = [b"", b""]
            out.append([np.frombuffer(side, np.int32) for side in sides])
        for part in new:
            if len(part) > CACHE_CHARS:
                del a[part], b[part]
        return out


def segments(whole: str, size: int = SEGMENT) -> Iterator[str]:
    """``whole`` in segments, cut at single spaces between word characters, where parts of both sides end."""
    cut, at = re.compile(r"(?<=\w) (?=\w)"), 0
    while len(whole) - at > size and (found := cut.search(whole, at + size)):
        yield whole[at : found.start()]
        at = found.start()
    yield whole[at:] if at else whole


# -------------------------------------------------------------------- pieces


def diagonals(a: np.ndarray, b: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merged order of ends a and b is split each ``every`` ends: counts of a and of b before each split."""
    d = np.arange(0, len(a) + len(b), every)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := low < high).any():
        i = (low + high) // 2
        first = np.zeros(len(d), bool)
        first[open_] = a[i[open_]] <= b[d[open_] - 1 - i[open_]]  # a's end is among the first d
        low, high = np.where(open_ & first, i + 1, low), np.where(open_ & ~first, i, high)
    return np.r_[low, len(a)], np.r_[d - low, len(b)]


PIECES = (
    "row long, doc_id long, piece int, pieces int, a_start long, b_start long, n_a int, n_b int, a_ids binary, b_ids binary"
)


def encode(docs: DataFrame, a: ByteLevel, b: Pieces, rule: AlignRule, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of each row's text; ids as 16-bit integers, with the next token of the side where there is one."""
    small = id_type(a), id_type(b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, length = Parts(a, b), (byte_lengths(a), byte_lengths(b))

        def texts_with_ids(batch: pa.RecordBatch) -> Iterator[tuple[int, int | None, list[np.ndarray]]]:
            keys, held, size = zip(batch["row"].to_pylist(), batch["id"].to_pylist(), strict=True), [], 0
            for n, value in enumerate(batch["text"], 1):
                text = value.as_py()
                held.append(list(segments(" " + text)) if text else [])
                size += len(text or "")
                if size >= TOGETHER or n == batch.num_rows:
                    for ids in known.ids(held):
                        yield *next(keys), ids
                    held, size = [], 0

        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for row, doc_id, ids in texts_with_ids(batch):
                ends = [np.cumsum(length[s][ids[s]]) for s in (0, 1)]
                splits = diagonals(*ends, rule.piece) if len(ids[0]) else (np.zeros(2, int), np.zeros(2, int))
                last = len(splits[0]) - 2
                for piece in range(last + 1):
                    cut = [(int(at[piece]), int(at[piece + 1])) for at in splits]
                    start = [int(ends[s][cut[s][0] - 1]) if cut[s][0] else 0 for s in (0, 1)]
                    data = [ids[s][cut[s][0] : cut[s][1] + 1].astype(small[s]).tobytes() for s in (0, 1)]
                    rows.append((row, doc_id, piece, last + 1, *start, *(hi - lo for lo, hi in cut), *data))
                    size += len(data[0]) + len(data[1])
                if size > 4 << 20:
                    yield record_batch(rows)
                    rows, size = [], 0
            if rows:
                yield record_batch(rows)

    def record_batch(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in PIECES.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, PIECES)


def id_type(side: ByteLevel | Pieces) -> str:
    return "<u2" if len(side.entries) <= 1 << 16 else "<i4"


def byte_lengths(side: ByteLevel | Pieces) -> np.ndarray:
    return np.array([len(e) for e in side.entries], np.int64)


# --------------------------------------------------------------------- links


@dataclass
class Side:
    """A side of a batch of pieces: ids, ends in one rising order, the row of each, and whether it is the row's own."""

    ids: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    own: np.ndarray

    @classmethod
    def of(cls, lists: pa.Array, starts: np.ndarray, own: np.ndarray, length: np.ndarray, kind: str) -> Side:
        width = np.dtype(kind).itemsize
        count = np.array([len(v.as_buffer()) // width if v.is_valid else 0 for v in lists], np.int64)
        ids = np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in lists]).astype(np.int64)
        row = np.repeat(np.arange(len(count)), count)
        total = np.cumsum(length[ids])
        first = np.cumsum(count) - count
        before = np.r_[0, total][first]
        place = np.arange(len(ids)) - first[row]
        return cls(ids, total - before[row] + starts[row] + row * APART, row, place < own[row])


@dataclass
class Links:
    """Links of a batch by the end that makes them: first those of A's ends, then those that only B has."""

    a: Side
    b: Side
    pair: np.ndarray
    row: np.ndarray
    cut: np.ndarray  # of b: whether it closes a group

    @classmethod
    def of(cls, batch: pa.RecordBatch, lengths: tuple[np.ndarray, np.ndarray], kinds: tuple[str, str], base: int) -> Links:
        number = lambda c: batch[c].to_numpy(zero_copy_only=False).astype(np.int64)
        a_start = number("a_start")
        a = Side.of(batch["a_ids"], a_start, number("n_a"), lengths[0], kinds[0])
        b = Side.of(batch["b_ids"], number("b_start"), number("n_b"), lengths[1], kinds[1])
        end_a, end_b = a.ends[a.own], b.ends
        with_a = np.searchsorted(b.ends, end_a)  # B's token that holds the byte before A's end
        at = np.searchsorted(a.ends, end_b)
        common = np.zeros(len(end_b), bool)
        inside = at < len(a.ends)
        common[inside] = a.ends[at[inside]] == end_b[inside]
        common |= end_b == a_start[b.row] + b.row * APART  # the end of A's last token of the piece before
        alone = b.own & ~common
        pair = np.r_[a.ids[a.own] * base + b.ids[with_a], a.ids[at[alone]] * base + b.ids[alone]]
        return cls(a, b, pair, np.r_[a.row[a.own], b.row[alone]], common & b.own)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``TOKENS`` tokens."""
    for batch in batches:
        total = np.cumsum(batch["n_a"].to_numpy().astype(np.int64) + batch["n_b"].to_numpy())
        first = 0
        while first < batch.num_rows:
            done = total[first - 1] if first else 0
            end = max(first + 1, int(np.searchsorted(total, done + TOKENS, side="right")))
            yield batch.slice(first, end - first)
            first = end


def count_pairs(pieces: DataFrame, a: ByteLevel, b: Pieces, rule: AlignRule) -> DataFrame:
    """(pair, n): how many links of the corpus hold each id pair; pair is A's id times B's vocabulary and B's id."""
    lengths, kinds, base = (byte_lengths(a), byte_lengths(b)), (id_type(a), id_type(b)), len(b.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, more = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def sum_up() -> tuple[np.ndarray, np.ndarray]:
            every, where = np.unique(np.concatenate([pairs, *(m[0] for m in more)]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, where, np.concatenate([counts, *(m[1] for m in more)]))
            return every, total

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

        for batch in slices(batches):
            more.append(np.unique(Links.of(batch, lengths, kinds, base).pair, return_counts=True))
            if sum(len(m[0]) for m in more) > rule.held_pairs:
                (pairs, counts), more = sum_up(), []
                if len(pairs) > rule.held_pairs:
                    yield out()
                    pairs, counts = pairs[:0], counts[:0]
        pairs, counts = sum_up()
        yield out()

    return pieces.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


@dataclass
class Known:
    """Counts that every task has: of the frequent pairs, in order, and the highest of each B id."""

    pairs: np.ndarray
    counts: np.ndarray
    best: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, best: DataFrame, vocabulary: int, most: int) -> Known:
        # how many pairs there are by steps of a sixteenth of a doubling: some hundred rows
        step = F.floor(F.log2("n") * 16)
        listed = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).orderBy(F.desc("step")).collect()
        least, total = None, 0
        for r in listed:
            total += r.pairs
            if total > most:
                break
            least = r.step
        found = counts.where(step >= least if least is not None else F.lit(False)).toArrow().sort_by("pair")
        highest = np.zeros(vocabulary, np.int64)
        table = best.toArrow()
        highest[table["b"].to_numpy()] = table["best"].to_numpy()
        return cls(found["pair"].to_numpy(), found["n"].to_numpy(), highest)

    def find(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, whether it is known) of each pair."""
        if not len(self.pairs):
            return np.zeros(len(pair), np.int64), np.zeros(len(pair), bool)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        known = self.pairs[at] == pair
        return np.where(known, self.counts[at], 0), known


# ------------------------------------------------------------ group listings


class Digits:
    """Decimal ids as rows of bytes, one byte behind them free for a separator."""

    def __init__(self, size: int) -> None:
        text = [str(i).encode() for i in range(size)]
        self.length = np.array([len(t) for t in text], np.int64)
        width = int(self.length.max(initial=1)) + 1
        self.table = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text), np.uint8).reshape(size, width)


def listing(links: Links, digits: tuple[Digits, Digits], rows: int) -> tuple[bytes, np.ndarray, list[np.ndarray]]:
    """(text, offset of each row in it, group of each own token of A and B): groups in order, each closed by a semicolon.

    Groups number through the batch; the tokens behind a row's last cut are a group of their own.
    """
    cuts = links.b.ends[links.cut]
    sides = links.a, links.b
    own = [s.own for s in sides]
    group = [np.searchsorted(cuts, s.ends[o]) + s.row[o] for s, o in zip(sides, own, strict=True)]
    place = [
        np.arange(len(group[0])) + np.searchsorted(group[1], group[0], side="left"),
        np.arange(len(group[1])) + np.searchsorted(group[0], group[1], side="right"),
    ]
    width = max(d.table.shape[1] for d in digits)
    out = np.zeros((len(group[0]) + len(group[1]), width), np.uint8)
    length = np.zeros(len(out), np.int64)
    row = np.zeros(len(out), np.int64)
    for s in (0, 1):
        ids, g = sides[s].ids[own[s]], group[s]
        last = np.r_[g[1:] != g[:-1], True][: len(g)]
        data = np.zeros((len(ids), width), np.uint8)
        data[:, : digits[s].table.shape[1]] = digits[s].table[ids]
        data[np.arange(len(ids)), digits[s].length[ids]] = np.where(last, ord("|;"[s]), ord(","))
        out[place[s]], length[place[s]], row[place[s]] = data, digits[s].length[ids] + 1, sides[s].row[own[s]]
    offsets = np.r_[0, np.cumsum(np.bincount(row, length, rows).astype(np.int64))]
    return out[out != 0].tobytes(), offsets, group


def open_ends(links: Links, group: list[np.ndarray], row: int, text: bytes) -> dict[str, bytes]:
    """First and last group of a piece, each side by itself, and the listing of the groups between."""
    ids = [s.ids[s.own][s.row[s.own] == row] for s in (links.a, links.b)]
    here = [g[s.row[s.own] == row] for g, s in zip(group, (links.a, links.b), strict=True)]
    cut = links.cut & (links.b.row == row)
    n = int(cut.sum())
    first = int(np.searchsorted(links.b.ends[links.cut], row * APART)) + row  # the number of its first group
    part = lambda s, g: ",".join(map(str, ids[s][here[s] == g].tolist())).encode()
    out = {"head_a": part(0, first), "head_b": part(1, first), "tail_a": b"", "tail_b": b"", "body": b""}
    if n:
        out |= {"tail_a": part(0, first + n), "tail_b": part(1, first + n)}
        skip = sum(len(out[c]) + 1 for c in ("head_a", "head_b") if out[c])
        end = sum(len(out[c]) + 1 for c in ("tail_a", "tail_b") if out[c])
        out["body"] = text[skip : len(text) - end].removesuffix(b";")
    return out


ENDS = ["head_a", "head_b", "body", "tail_a", "tail_b"]
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(pieces: DataFrame, a: ByteLevel, b: Pieces, known: Known) -> DataFrame:
    """A row for each piece: its counts, the digest of its groups or its open ends, and its links by pairs not known."""
    lengths, kinds, base = (byte_lengths(a), byte_lengths(b)), (id_type(a), id_type(b)), len(b.entries)
    sizes = len(a.entries), len(b.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = Digits(sizes[0]), Digits(sizes[1])
        for batch in slices(batches):
            rows = batch.num_rows
            links = Links.of(batch, lengths, kinds, base)
            count, found = known.find(links.pair)
            is_best = found & (count == known.best[links.pair % base])
            each = lambda flags: np.bincount(links.row[flags], minlength=rows)
            sums = np.zeros(rows, np.int64)
            np.add.at(sums, links.row, count)
            out = {
                "n_a": batch["n_a"].cast(pa.int64()),
                "n_b": batch["n_b"].cast(pa.int64()),
                "n_groups": np.bincount(links.b.row[links.cut], minlength=rows),
                "n_links": np.bincount(links.row, minlength=rows),
                "n_best": each(is_best),
                "count_sum": sums,
            }
            text, offsets, group = listing(links, digits, rows)
            digests, ends = [], {c: [] for c in ENDS}
            for r, pieces_ in enumerate(batch["pieces"].to_pylist()):
                mine = text[offsets[r] : offsets[r + 1]]
                whole = pieces_ == 1
                digests.append((hashlib.sha256(mine[:-1]).hexdigest() if mine else "") if whole else None)
                parts = {} if whole else open_ends(links, group, r, mine)
                for c in ENDS:
                    ends[c].append(parts.get(c))
            rare_row, rare_pair = links.row[~found], links.pair[~found]
            order = np.lexsort((rare_pair, rare_row))
            rare_row, rare_pair = rare_row[order], rare_pair[order]
            new = np.flatnonzero(np.r_[True, (rare_row[1:] != rare_row[:-1]) | (rare_pair[1:] != rare_pair[:-1])][: len(order)])
            times = np.diff(np.r_[new, len(order)])
            offsets = np.searchsorted(rare_row[new], np.arange(rows + 1)).astype(np.int32)
            rare = pa.StructArray.from_arrays([pa.array(rare_pair[new]), pa.array(times.astype(np.int64))], ["pair", "times"])
            arrays = [batch["row"], batch["doc_id"], batch["piece"], batch["pieces"], *(pa.array(out[c], pa.int64()) for c in COUNTS)]
            arrays += [pa.array(digests, pa.string()), *(pa.array(ends[c], pa.binary()) for c in ENDS)]
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), rare))
            names = ["row", "doc_id", "piece", "pieces", *COUNTS, "groups_sha256", *ENDS, "rare"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "row long, doc_id long, piece int, pieces int, " + ", ".join(f"{c} long" for c in COUNTS)
    schema += ", groups_sha256 string, " + ", ".join(f"{c} binary" for c in ENDS)
    return pieces.mapInArrow(run, schema + ", rare array<struct<pair: long, times: long>>")


def stitch(found: DataFrame) -> DataFrame:
    """(row, groups_sha256) of documents of several pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, some = None, hashlib.sha256(), False
        held: tuple[list[bytes], list[bytes]] = ([], [])  # the open group, by side

        def add(text: bytes) -> None:
            nonlocal some
            digest.update(b";" + text if some else text)
            some = True

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([digest.hexdigest()])], ["row", "groups_sha256"])

        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch[c][r].as_py() for c in ("row", "n_groups", *ENDS)}
                if row["row"] != at:
                    if at is not None:
                        yield out()
                    at, digest, some, held = row["row"], hashlib.sha256(), False, ([], [])
                for side, c in enumerate(("head_a", "head_b")):
                    held[side].extend([row[c]] if row[c] else [])
                if row["n_groups"]:
                    add(b",".join(held[0]) + b"|" + b",".join(held[1]))
                    if row["body"]:
                        add(row["body"])
                    held = [row["tail_a"]] if row["tail_a"] else [], [row["tail_b"]] if row["tail_b"] else []
        if at is not None:
            yield out()

    several = found.where("pieces > 1").select("row", "piece", "n_groups", *ENDS)
    return several.repartition("row").sortWithinPartitions("row", "piece").mapInArrow(run, "row long, groups_sha256 string")


def align_documents(
    docs: DataFrame, a: ByteLevel, b: Pieces, rule: AlignRule = AlignRule(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row for each row of ``docs``."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "alignment")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    pieces = stored(encode(docs, a, b, rule, key, text), "pieces")
    counts = stored(count_pairs(pieces, a, b, rule), "counts")
    base = len(b.entries)
    best = counts.groupBy((F.col("pair") % base).alias("b")).agg(F.max("n").alias("best"))
    known = Known.of(counts, best, base, rule.known_pairs)
    found = stored(align(pieces, a, b, known), "found")
    rare = found.select("row", F.explode("rare").alias("_r")).select("row", "_r.*").join(counts, "pair")
    rare = rare.withColumn("b", F.col("pair") % base).join(F.broadcast(best), "b")  # a row for each B id at most
    more = rare.select(
        "row",
        F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long")).alias("n_best"),
        (F.col("times") * F.col("n")).alias("count_sum"),
    )
    kept = found.select("row", "doc_id", *COUNTS, "groups_sha256")
    # a document's pieces, rare links and digest meet by its row number
    every = kept.unionByName(more, allowMissingColumns=True).unionByName(stitch(found), allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in COUNTS]
    each = every.groupBy("row").agg(F.max("doc_id").alias(key), *sums, F.max("groups_sha256").alias("groups_sha256"))
    return each.select(key, *COUNTS, "groups_sha256")
