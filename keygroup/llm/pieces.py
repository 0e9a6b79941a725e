"""Encoding and decoding with merge-type piece vocabularies.

A text is encoded by an agenda of adjacent symbol pairs: the pair whose piece has
the best score is merged first, the leftmost of equals, until no pair is a piece.
A pair of characters that no piece holds side by side can never be merged, so a
text falls apart at such places, above all before each space. Each part has an agenda
of its own, and the parts of many words make their merges side by side. Every distinct
word that a task meets is also encoded by the sentencepiece library, a batch at a time;
where the two differ, the library's ids count, and ``n_corrected`` tells how many words
of the document that touched. Ids are decoded by the library, a batch at a time.
"""

from __future__ import annotations

import codecs
import heapq
import sys
import types
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keygroup.llm.common import picked
from keygroup.llm.numbered import Numbered, alike_long, code_points, utf8_width

SPACE = "▁"
# Distinct words of either generation that a worker remembers.
REMEMBERED = 300_000
# Longer parts are merged one by one: every merge looks at a whole part here.
_LONG = 64
# Characters of words that are encoded at once, and of parts that are merged side by side.
BLOCK, FRAME = 1_000_000, 250_000
# In the agenda of many parts, the bits of a pair's cell, and what the pairs that are no piece are from.
_CELL_BITS = 32
_CELL, _NEVER = (1 << _CELL_BITS) - 1, 1 << 62


class Pieces:
    """A vocabulary of merge type with byte fallback, read from a model file."""

    def __init__(self, model_path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = self.library.get_piece_size()
        self.end_id = self.library.eos_id()
        self.ids: dict[str, int] = {}
        self.bytes_id = [-1] * 256
        self.plain: list[bytes] = []
        self.controls: set[int] = set()
        for i in range(size):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes_id[value] = i
                self.plain.append(bytes([value]))
            elif self.library.is_control(i) or self.library.is_unknown(i):
                self.plain.append(" ⁇ ".encode() if self.library.is_unknown(i) else b"")
                if self.library.is_control(i):
                    self.controls.add(i)
            elif self.library.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            else:
                self.ids[piece] = i
                self.plain.append(piece.replace(SPACE, " ").encode())
        if -1 in self.bytes_id:
            raise ValueError("the vocabulary needs a piece for every byte")
        scores = {piece: self.library.get_score(i) for piece, i in self.ids.items()}
        place = {score: at for at, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {piece: place[score] for piece, score in scores.items()}
        # A space starts a part if no piece has one behind another character.
        self.pairs = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        if any(pair[1] == SPACE and pair[0] != SPACE for pair in self.pairs):
            raise ValueError("pieces that go on behind a space are not supported")
        self._number_pairs(size)
        self.opening = {i for piece, i in self.ids.items() if piece[0] == SPACE}
        codecs.register_error("one_mark_per_byte", _marks)
        probe = " a  b\t"
        if self.decode(self.encode(probe)) != probe or self.library.decode(self.library.encode(probe)) != probe:
            raise ValueError("only vocabularies that leave white space as it is are supported")

    def _number_pairs(self, size: int) -> None:
        """Symbols as numbers: of a piece its id, of another character its code point behind the ids."""
        self.first_character = size
        self.symbols = np.arange(size, size + sys.maxunicode + 1, dtype=np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbols[ord(piece)] = i
        keys, joined = [], [0]
        for piece, i in self.ids.items():
            for at in range(1, len(piece)):
                left, right = self._symbol(piece[:at]), self._symbol(piece[at:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    joined.append(i)
        self.joins = Numbered(len(keys))
        self.joins.add(np.array(keys, np.int64))
        self.joined = np.array(joined, np.int32)
        ranks = np.zeros(size, np.int64)
        ranks[list(self.ids.values())] = [self.ranks[piece] for piece in self.ids]
        self.join_agenda = ranks[self.joined] << _CELL_BITS
        self.join_agenda[0] = _NEVER
        self.neighbours = Numbered(len(self.pairs))
        self.neighbours.add(np.array([ord(a) << 32 | ord(b) for a, b in self.pairs], np.int64))
        self.byte_ids = np.array(self.bytes_id, np.int32)

    def _symbol(self, text: str) -> int | None:
        found = self.ids.get(text)
        return self.first_character + ord(text) if found is None and len(text) == 1 else found

    # -- one part ---------------------------------------------------------------

    def agenda(self, part: str) -> list[str]:
        """The symbols that a text falls into, each where it begins, and empty ones between.

        An entry of the agenda is one number: the rank of the pair's score, then its
        place. It is stale if the pair at that place now has another rank.
        """
        rank = self.ranks.get
        symbols = list(part)
        end = len(symbols)
        agenda = []
        for i in range(end - 1):
            found = rank(symbols[i] + symbols[i + 1])
            if found is not None:
                agenda.append(found * end + i)
        if agenda:
            heapq.heapify(agenda)
            after = list(range(1, end + 1))
            before = list(range(-1, end - 1))
            while agenda:
                found, i = divmod(heapq.heappop(agenda), end)
                j = after[i]
                if not symbols[i] or j == end:
                    continue
                merged = symbols[i] + symbols[j]
                if rank(merged) != found:
                    continue
                symbols[i], symbols[j] = merged, ""
                k = after[i] = after[j]
                if k < end:
                    before[k] = i
                    found = rank(merged + symbols[k])
                    if found is not None:
                        heapq.heappush(agenda, found * end + i)
                h = before[i]
                if h >= 0:
                    found = rank(symbols[h] + merged)
                    if found is not None:
                        heapq.heappush(agenda, found * end + h)
        return symbols

    def merge(self, part: str) -> list[int]:
        """Ids of a text in which spaces are marked, by the agenda of pairs."""
        ids = []
        for symbol in self.agenda(part):
            if symbol:
                found = self.ids.get(symbol)
                if found is not None:
                    ids.append(found)
                else:
                    ids.extend(self.bytes_id[b] for b in symbol.encode())
        return ids

    def parts(self, marked: str) -> Iterator[str]:
        """The stretches of a marked text between which no merge can happen."""
        pairs, start = self.pairs, 0
        for i in range(1, len(marked)):
            if marked[i - 1 : i + 1] not in pairs:
                yield marked[start:i]
                start = i
        if start < len(marked):
            yield marked[start:]

    # -- many words ---------------------------------------------------------------

    def merge_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in which spaces are marked, one after another, and how many each has; no word is empty."""
        points, lengths = code_points(words)
        starts = np.cumsum(lengths) - lengths
        cut = np.ones(len(points), bool)
        cut[1:] = self.neighbours.find(_pair(points[:-1], points[1:])) == 0
        cut[starts] = True
        begin = np.flatnonzero(cut)
        size = np.diff(begin, append=len(points))
        symbols = self.symbols[points]
        for at, n in zip(begin[size > _LONG].tolist(), size[size > _LONG].tolist()):
            part = points[at : at + n].tobytes().decode("utf-32-le")
            symbols[at : at + n] = [self._symbol(x) if x else -1 for x in self.agenda(part)]
        short = np.flatnonzero((size > 1) & (size <= _LONG))
        for frame in alike_long(size[short], FRAME):
            frame = short[frame]
            self._side_by_side(symbols, begin[frame], size[frame])
        alive = symbols >= 0
        ids = symbols[alive]
        spelled = ids >= self.first_character
        width = np.where(spelled, utf8_width(ids - self.first_character), 1)
        taken = np.zeros(len(points), np.int64)
        taken[alive] = width
        characters = (ids[spelled] - self.first_character).astype(np.uint32).tobytes().decode("utf-32-le")
        ids, spelled = np.repeat(ids, width), np.repeat(spelled, width)
        ids[spelled] = self.byte_ids[np.frombuffer(characters.encode(), np.uint8)]
        return ids, np.add.reduceat(taken, starts)

    def _side_by_side(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Merge parts of falling size, a pair of each at a time; merged symbols stand where they begin, -1 after them.

        Cells have a row for each place in a part and a column for each part. The last
        row, which also counts as the one before the first, lies outside of every part.
        An entry of the agenda is the rank of a pair's score, then the pair's cell.
        """
        n, rows = len(begin), int(size[0]) + 1
        row = np.arange(rows)[:, None]
        inside = (row < size).ravel()
        places = (begin + row).ravel()[inside]
        held = np.full(rows * n, -1)
        held[inside] = symbols[places]
        cells = np.arange(rows * n)
        after, before = cells + n, cells - n
        before[:n] += rows * n
        found = self.joins.find(_pair(held, np.roll(held, -n)))
        joined, agenda = self.joined[found], self.join_agenda[found] | cells
        while True:
            first = agenda.reshape(rows, n).min(axis=0)
            i = first[first < _NEVER] & _CELL
            if not len(i):
                break
            j = after[i]
            k, h, merged = after[j], before[i], joined[i]
            held[i], held[j], agenda[j] = merged, -1, _NEVER
            after[i], before[k] = k, i
            found = self.joins.find(np.concatenate([_pair(merged, held[k]), _pair(held[h], merged)]))
            changed = np.concatenate([i, h])
            joined[changed], agenda[changed] = self.joined[found], self.join_agenda[found] | changed
        symbols[places] = held[inside]

    # -- whole texts ------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without an end id."""
        if not text:
            return []
        return [i for part in self.parts(SPACE + text.replace(" ", SPACE)) for i in self.merge(part)]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; control pieces vanish, a broken character gives one mark per byte."""
        plain = self.plain
        ids = list(ids)
        if self.controls.isdisjoint(ids[:-1]):
            text = b"".join([plain[i] for i in ids]).decode("utf-8", "one_mark_per_byte")
        else:
            # Bytes on both sides of a control piece make no character together.
            cuts = [-1, *(at for at, i in enumerate(ids) if i in self.controls), len(ids)]
            runs = (ids[a + 1 : b] for a, b in zip(cuts, cuts[1:]))
            text = "".join(b"".join([plain[i] for i in run]).decode("utf-8", "one_mark_per_byte") for run in runs)
        # The space that encoding puts before a text goes, unless it was written as a byte.
        first = next((i for i in ids if plain[i]), None)
        return text[1:] if first in self.opening else text


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Keys of pairs; one with -1 on either side is negative, so that none is found."""
    return np.left_shift(left, 32, dtype=np.int64) | right


def _marks(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


class Memory:
    """A bounded dictionary in two generations.

    What is used goes into the young one. When that is full it becomes the old one, and
    what was not used since the last time is forgotten; so frequent keys stay.
    """

    def __init__(self, size: int):
        self.size = size
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def age(self) -> None:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None:
            found = self.old.pop(key, None)
            if found is not None:
                self.young[key] = found
        return found


class Encoder:
    """Encodes many texts and remembers the words it has met."""

    def __init__(self, model_path: str):
        self.pieces = Pieces(model_path)
        self.words = Memory(REMEMBERED)
        self.corrected: set[str] = set()

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the words not met before, and check them against the library.

        Afterwards the young words hold every word of the texts.
        """
        self.words.age()
        words = self.words.young
        new = [w for w in set().union(*texts).difference(words) if self.words.get(w) is None]
        for block in _blocks(new):
            ids, counts = self.pieces.merge_all([SPACE + word.replace(" ", SPACE) for word in block])
            checked = self.pieces.library.encode(block, num_threads=1)
            raw, ends = ids.tobytes(), np.cumsum(counts) * ids.itemsize
            words.update(zip(block, [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]))
            self.corrected.difference_update(block)
            for i in _differing(ids, counts, checked):
                # The library takes an empty text for no word at all, not for a lone space.
                if block[i]:
                    words[block[i]] = array("i", checked[i]).tobytes()
                    self.corrected.add(block[i])

    def run(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Ids of every text, and how many of its words were corrected."""
        # Between two spaces in a row there is an empty word. Merges of several spaces
        # reach over such words, so they stay joined to the word behind them.
        split = [_words(text) for text in texts]
        self.learn(split)
        words, corrected = self.words.young, self.corrected
        ids = [np.frombuffer(b"".join(map(words.__getitem__, text)), np.int32) for text in split]
        return ids, [sum(w in corrected for w in text) if corrected else 0 for text in split]

    def decoded(self, ids: list[np.ndarray]) -> list[str]:
        """The texts of a batch of ids, by the library."""
        return self.pieces.library.decode([x.tolist() for x in ids], num_threads=1) if ids else []


def _blocks(words: list[str]) -> Iterator[list[str]]:
    """Words in order, so many at a time that their characters make a block; a longer word is one."""
    start = total = 0
    for at, word in enumerate(words):
        total += len(word) + 1
        if total > BLOCK and at > start:
            yield words[start:at]
            start, total = at, len(word) + 1
    if start < len(words):
        yield words[start:]


def _differing(ids: np.ndarray, counts: np.ndarray, lists: list[list[int]]) -> list[int]:
    """Which of the stretches of ``ids``, of so many each, differ from these lists."""
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    others = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
    alike = counts == sizes
    differ = ids[np.repeat(alike, counts)] != others[np.repeat(alike, sizes)]
    at_fault = np.repeat(np.flatnonzero(alike), counts[alike])[differ]
    return sorted({*np.flatnonzero(~alike).tolist(), *at_fault.tolist()})


def _words(text: str) -> list[str]:
    if not text:
        return []
    words = text.replace(SPACE, " ").split(" ")
    if "" not in words:
        return words
    joined, spaces = [], 0
    for word in words[:-1]:
        if word:
            joined.append(" " * spaces + word)
            spaces = 0
        else:
            spaces += 1
    joined.append(" " * spaces + words[-1])
    return joined


def encoder_of_process(model_path: str) -> Encoder:
    """One encoder per Python worker, so that later tasks find the words of earlier ones."""
    held = sys.modules.setdefault("keygroup_encoders", types.ModuleType("keygroup_encoders")).__dict__
    if model_path not in held:
        held[model_path] = Encoder(model_path)
    return held[model_path]


def encode(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text", end_id: bool = True
) -> DataFrame:
    """Encode whole texts and decode the ids again.

    Returns ``doc_id`` (as the id column), ``ids``, ``decoded`` and ``n_corrected``,
    one row per row, repeated rows included. A null or empty text has no ids but the
    end id and decodes to an empty text. Null document ids stay null; other columns
    are left out, whatever their names. ``model_path`` is a file on every machine.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    id_type = rows.schema["doc_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, ids array<int>, decoded string, n_corrected int"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of_process(model_path)
        ending = np.array([encoder.pieces.end_id] if end_id else [], np.int32)
        for whole in stream:
            for at in range(0, whole.num_rows, 256):
                part = whole.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids, corrected = encoder.run(texts)
                ids = [np.concatenate([x, ending]) for x in ids]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(offsets, np.concatenate(ids)),
                        pa.array(encoder.decoded(ids), pa.string()),
                        pa.array(corrected, pa.int32()),
                    ],
                    names=["doc_id", "ids", "decoded", "n_corrected"],
                )

    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """Number of ids, and digests of the ids in decimal and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
        "n_corrected",
    )
