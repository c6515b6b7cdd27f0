"""Best-fit packing of token sequences with a linear grouping scheme.

Documents become pieces of at most ``capacity`` tokens. Pieces are spread evenly over
shards by a hash; each shard is packed on its own, so nothing grows with the input but
the number of shards. In a shard, large pieces are sorted and cut into groups of equal
cardinality, each rounded up to its largest member. A configuration is a choice of
rounded lengths that fits one sequence; a linear program over configurations, solved by
column generation, covers all groups with as few sequences as possible. Actual pieces
then take the rounded places. Pieces left over by rounding the program's solution down,
and all small pieces, are put where they fit best.

Only piece lengths are shuffled, never texts or tokens. A sequence's number is unique
and says nothing more.

Defined results: NULL text is the empty text, which still has its closing token.
Repeated rows are packed once each. Only documents longer than the capacity are cut.
"""

import functools
import os
import re
import sys
import zlib
from array import array

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.tasks import releasing
from quizloom.llm.text import with_fields
from quizloom.operators.storage import materialise

CAPACITY = 2048
# A piece of at most this share of a sequence is small.
SMALL_SHARE = 1 / 3
GROUPS = 96
SHARD_PIECES = 40_000
END_ID = 0

# The vocabulary drops white space and never joins across it, so words can be encoded
# one by one and remembered. Texts are cut at ASCII white space only: any other stays in
# its word, which the whole tokenizer then reads.
_CACHE_WORDS = 1 << 14
_CACHE_LETTERS = 1 << 18
_CACHE_CHARS = 64
# Texts that are split and looked up together; a longer text is worked on by itself.
BLOCK_BYTES = 4 << 20
# Letters that are a single unit for the vocabulary's splitter and composed as they are;
# one closing mark is a unit of its own.
_PLAIN = re.compile(
    "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)([.,;:!?]?)"
)


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Fixed values: printable bytes stand for themselves, the others for the characters
    from 256 on.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder(dict):
    """Token ids of texts as little-endian unsigned 32-bit numbers; a cache by word.

    Words are remembered, and so are the letters of plain words without their case and
    closing mark; those go straight to the vocabulary's model, all others through the
    whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._bytes = _byte_characters()
        self._letters: dict[str, bytes] = {}

    def _plain(self, letters: str) -> bytes:
        ids = self._letters.get(letters)
        if ids is None:
            spelled = letters
            if not letters.isascii():
                spelled = letters.encode().decode("latin-1").translate(self._bytes)
            ids = _packed([token.id for token in self._model.tokenize(spelled)])
            _remember(self._letters, letters, ids, _CACHE_LETTERS)
        return ids

    def __missing__(self, word: str) -> bytes:
        plain = _PLAIN.fullmatch(word)
        if plain:
            letters, mark = plain.groups()
            ids = self._plain(letters.lower())
            if mark:
                ids += self[mark]
        else:
            ids = _packed(self._tokenizer.encode(word, add_special_tokens=False).ids)
        _remember(self, word, ids, _CACHE_WORDS)
        return ids

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the ends of the texts among them.

        Each distinct word is looked up once.
        """
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        flat = words.flatten().dictionary_encode()
        known = [self[word] for word in flat.dictionary.to_numpy(zero_copy_only=False).tolist()]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        which = flat.indices.to_numpy()
        size = sizes[which]
        ends = np.cumsum(size)
        places = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - size), size)
        places += np.arange(len(places))
        return ids[places], np.append(0, ends)[words.offsets.to_numpy()[1:]]


def _blocks(batch: pa.RecordBatch):
    """Neighbouring rows of about ``BLOCK_BYTES`` of text."""
    bytes_ = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
    number = (np.cumsum(bytes_, dtype=np.int64) - bytes_) // BLOCK_BYTES
    starts = np.flatnonzero(np.diff(number, prepend=-1)).tolist()
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(start, end - start)


def _remember(cache: dict[str, bytes], word: str, ids: bytes, most: int) -> None:
    """Keep the ids of a word; a full cache starts anew, also in the middle of a block."""
    if len(word) <= _CACHE_CHARS:
        if len(cache) >= most:
            cache.clear()
        cache[word] = ids


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


PIECES = "doc_id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT, unit BIGINT"


def token_pieces(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece; ``ids`` (array of int) on request.

    ``unit`` numbers the rows of the scan, so that repeated documents differ.
    """

    def cut(batches):
        encoder = _encoder(tokenizer)
        unit = TaskContext.get().partitionId() << 33
        for batch in (block for batch in batches for block in _blocks(batch)):
            columns = {name: array("q") for name in ("piece", "start", "length", "crc", "unit")}
            docs, ids = [], []
            all_ids, ends = encoder.encode_all(batch.column("text"))
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), np.split(all_ids, ends[:-1])):
                tokens = own.tobytes() + END_ID.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    docs.append(doc_id)
                    row = (piece, at // 4, len(part) // 4, zlib.crc32(part), unit)
                    for column, value in zip(columns.values(), row):
                        column.append(value)
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
                    unit += 1
            arrays = [np.asarray(c, dtype=np.int64) for c in columns.values()]
            out = {
                "doc_id": pa.array(docs, pa.int64()),
                "piece": pa.array(arrays[0].astype(np.int32)),
                "start": pa.array(arrays[1]),
                "length": pa.array(arrays[2]),
                "ids_crc32": pa.array(arrays[3]),
                "unit": pa.array(arrays[4]),
            }
            if with_ids:
                out["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)
        # The letters stay for the worker's next task; whole words would take too much.
        encoder.clear()

    schema = PIECES + (", ids ARRAY<INT>" if with_ids else "")
    rows = documents.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(releasing(cut), schema)


def linear_groups(lengths: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Rounded lengths, rising, and for each of the descending ``lengths`` its group."""
    size = max(1, -(-len(lengths) // groups))
    rounded = lengths[(np.arange(len(lengths)) // size) * size]
    sizes, group = np.unique(rounded, return_inverse=True)
    return sizes, group


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int, most: int):
    """Configuration of the greatest worth with at most ``most`` pieces."""
    best = np.zeros(capacity + 1)
    layers = []
    for _ in range(most):
        gain = np.full((len(sizes), capacity + 1), -np.inf)
        for g, s in enumerate(sizes):
            gain[g, s:] = best[: capacity + 1 - s] + worth[g]
        pick = gain.argmax(axis=0)
        top = gain[pick, np.arange(capacity + 1)]
        use = top > best + 1e-12
        layers.append(np.where(use, pick, -1))
        best = np.where(use, top, best)
    counts, room = np.zeros(len(sizes)), capacity
    for layer in reversed(layers):
        if layer[room] >= 0:
            counts[layer[room]] += 1
            room -= sizes[layer[room]]
    return counts, best[capacity]


def configurations(
    sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 400
) -> tuple[np.ndarray, np.ndarray]:
    """Configurations (columns) and how often each is used, as a linear program says.

    Simplex steps on the basis; a new column is the configuration that is worth most at
    the current prices. Ends at the optimum, or after ``rounds`` with a basis that still
    covers the demand.
    """
    basis = np.diag((capacity // sizes).astype(np.float64))
    most = int(capacity // sizes.min())
    inverse = np.linalg.inv(basis)
    for step in range(rounds):
        amount = inverse @ demand
        prices = np.ones(len(sizes)) @ inverse
        column, worth = best_configuration(sizes, np.maximum(prices, 0), capacity, most)
        if worth <= 1 + 1e-7:
            break
        change = inverse @ column
        up = change > 1e-9
        if not up.any():
            break
        ratio = np.where(up, amount / np.where(up, change, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
        else:
            pivot = inverse[out] / change[out]
            inverse = inverse - np.outer(change, pivot)
            inverse[out] = pivot
    return basis, np.maximum(inverse @ demand, 0)


class Bins:
    """Open sequences, found by their free room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if some sequence has r tokens free
        self.count = 0

    def add(self, sequence: int, room: int) -> None:
        if room:
            self.by_room[room].append(sequence)
            self.rooms |= 1 << room

    def new(self) -> int:
        self.count += 1
        return self.count - 1

    def best_fit(self, length: int) -> tuple[int, int]:
        """The sequence that ``length`` tokens fill best, and its room before them."""
        fitting = self.rooms >> length
        if not fitting:
            return self.new(), self.capacity
        room = length + (fitting & -fitting).bit_length() - 1
        sequence = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms &= ~(1 << room)
        return sequence, room


class Shelf:
    """Pieces not yet placed, found by their length."""

    def __init__(self, lengths: np.ndarray, pieces: np.ndarray, capacity: int):
        self.by_length: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.present = 0  # bit n is set if some piece has n tokens
        for piece in pieces.tolist():
            self.by_length[lengths[piece]].append(piece)
            self.present |= 1 << int(lengths[piece])

    def take(self, most: int) -> int | None:
        """A longest piece of at most ``most`` tokens."""
        length = (self.present & ((1 << (most + 1)) - 1)).bit_length() - 1
        if length < 0:
            return None
        piece = self.by_length[length].pop()
        if not self.by_length[length]:
            self.present &= ~(1 << length)
        return piece

    def rest(self) -> list[int]:
        """All pieces left, longest first."""
        return [piece for pieces in reversed(self.by_length) for piece in pieces]


def pack_lengths(
    lengths: np.ndarray, capacity: int = CAPACITY, groups: int = GROUPS
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece."""
    sequence = np.full(len(lengths), -1, dtype=np.int64)
    offset = np.zeros(len(lengths), dtype=np.int64)
    bins = Bins(capacity)
    order = np.argsort(-lengths, kind="stable")
    descending = lengths[order]
    full = int((descending >= capacity).sum())
    sequence[order[:full]] = np.arange(full)
    bins.count = full
    large_end = int((descending > capacity * SMALL_SHARE).sum())
    large = order[full:large_end]
    waiting = []
    if large_end > full:
        large = order[full:large_end]
        sizes, group = linear_groups(lengths[large], groups)
        demand = np.bincount(group, minlength=len(sizes)).astype(np.float64)
        columns, amount = configurations(sizes, demand, capacity)
        shelf = Shelf(lengths, large, capacity)
        for column, times in zip(columns.T.astype(int), np.floor(amount + 1e-9).astype(int)):
            places = np.repeat(sizes, column)[::-1].tolist()
            for _ in range(times):
                number, room = None, capacity
                for i, place in enumerate(places):
                    # Pieces are shorter than their places. What that leaves over goes to
                    # the last place, which takes the longest piece that still fits.
                    piece = shelf.take(room if 0 < i == len(places) - 1 else min(place, room))
                    if piece is None:
                        continue
                    number = bins.new() if number is None else number
                    sequence[piece], offset[piece] = number, capacity - room
                    room -= int(lengths[piece])
                if number is not None:
                    bins.add(number, room)
        waiting = shelf.rest()
    for piece in [*waiting, *order[large_end:]]:
        length = int(lengths[piece])
        number, room = bins.best_fit(length)
        sequence[piece], offset[piece] = number, capacity - room
        bins.add(number, room - length)
    return sequence, offset


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
    groups: int = GROUPS,
) -> DataFrame:
    """``pieces`` (stored rows with ``length`` and ``unit``) with sequence_id and offset."""
    shards = max(1, round(pieces.count() / shard_pieces))
    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]

    def pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = pack_lengths(rows["length"].to_numpy(), capacity, groups)
        shard = int(rows["_shard"].iloc[0])
        return rows.drop(columns="_shard").assign(
            sequence_id=(np.int64(shard) << np.int64(32)) + sequence, offset=offset
        )

    schema = with_fields(pieces.select(*rest).schema, {"sequence_id": "long", "offset": "long"})
    # Equal shares: neighbours of the scan are dealt by a hash of their number.
    shard = F.pmod(F.xxhash64("unit"), F.lit(shards))
    return pieces.select(*rest, shard.alias("_shard")).groupBy("_shard").applyInPandas(
        pack_shard, schema
    )


def pack_documents(
    documents: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """All pieces of all documents with their places; texts are tokenized once."""
    pieces = materialise(token_pieces(documents, tokenizer or default_tokenizer(), capacity))
    return pack(pieces, capacity, shard_pieces).drop("unit")
