"""Token counts of a unigram model, with work shared between words that begin alike.

A word's best segmentation maximises the sum of its pieces' scores; ties go to fewer
pieces. The best score of a prefix does not depend on what follows, so a task keeps the
distinct words it meets in a trie: each node, a prefix, gets its forward score and its
count once, from its ancestors, and the node of a word holds the count of the word. When
the trie is full, the subtrees go that were not met for the longest time.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from keygroup.llm.common import picked
from keygroup.llm.numbered import Numbered, alike_long, code_points, utf8_width

SPACE = "▁"
# Nodes of a task's trie; half as many are left after a clearance.
NODES = 1_000_000
# Characters, the mark among them, that the nodes of a subtree share.
TOP = 4
# Words that go down the trie side by side, times their length.
FRAME = 1_000_000
# Bits of a character in the key of a node.
_CHARACTER = 21
# Longer words are counted along a window that is as long as the longest piece.
LONGEST_WORD = 200


def unigram_scores(model_path: str) -> tuple[dict[str, float], float]:
    """Log-scores of the pieces of a vocabulary, and that of a byte outside it.

    The vocabulary lists pieces by falling frequency; by Zipf's law a piece of rank r
    scores ``-log(r + 2)``. A byte scores one less than the last piece.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = {model.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(ids)}
    return pieces, -math.log(len(ids) + 2) - 1


def _key(above: np.ndarray, points: np.ndarray) -> np.ndarray:
    return above.astype(np.int64) << _CHARACTER | points


def _below(tree: Numbered, above: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes that one more character leads to, with those added, and where each of these is met first."""
    keys = _key(above, points)
    nodes = tree.find(keys)
    missing = np.flatnonzero(nodes == 0)
    if not len(missing):
        return nodes, missing, missing
    new, first, which = np.unique(keys[missing], return_index=True, return_inverse=True)
    added = tree.add(new)
    nodes[missing] = added[which]
    return nodes, missing[first], added


class Trie:
    """Counts of pieces in words; remembers prefixes, in a bounded number of nodes.

    A node is found by the one above it and its last character, and holds its forward
    score and count. Words go down the trie side by side, a character a step; the nodes
    that a step adds are scored together, along a trie of the pieces read backwards.
    """

    def __init__(self, pieces: dict[str, float], byte_score: float, nodes: int = 0):
        self.pieces, self.byte_score = pieces, byte_score
        self.nodes = nodes or NODES
        self.longest = max(map(len, pieces), default=1)
        # Lengths of the pieces that end in a character, to try no others.
        lengths: dict[str, set[int]] = {}
        for piece in pieces:
            lengths.setdefault(piece[-1], set()).add(len(piece))
        self.lengths = {last: sorted(found) for last, found in lengths.items()}
        self.endings = Numbered(len(pieces))
        backwards = [piece[::-1] for piece in pieces]
        points, sizes = code_points(backwards)
        starts, at = np.cumsum(sizes) - sizes, np.zeros(len(backwards), np.int32)
        for depth in range(self.longest if backwards else 0):
            longer = np.flatnonzero(sizes > depth)
            at[longer], _, _ = _below(self.endings, at[longer], points[starts[longer] + depth])
        self.ending_score = np.full(self.endings.size + 1, -np.inf)
        self.ending_score[at] = list(pieces.values())
        # The root, node 0, is the empty prefix; no node is numbered before one above it.
        self.tree = Numbered(min(self.nodes, 1 << 16))
        self.score, self.count = np.zeros(1), np.zeros(1, np.int64)
        # The round in which a node was last met, at least that of the nodes below it.
        self.met = np.zeros(1, np.int64)
        self.round = 0

    @property
    def size(self) -> int:
        return self.tree.size

    @property
    def tops(self) -> dict[int, list[int]]:
        """The nodes of every subtree, by its top; a node nearer to the root is a subtree by itself."""
        top, depth, found = [0], [0], {}
        for node, key in enumerate(self.tree.keys[1 : self.size + 1].tolist(), 1):
            above = key >> _CHARACTER
            depth.append(depth[above] + 1)
            top.append(node if depth[node] <= TOP else top[above])
            found.setdefault(top[node], []).append(node)
        return found

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        """Pieces of every word."""
        words = list(words)
        return dict(zip(words, self.counted(words).tolist()))

    def counted(self, words: list[str]) -> np.ndarray:
        """Pieces of every word, in order; a frame of words is met before anything is forgotten."""
        found = np.zeros(len(words), np.int64)
        if not words:
            return found
        points, lengths = code_points(words)
        starts = np.cumsum(lengths) - lengths
        long = lengths > LONGEST_WORD
        for i in np.flatnonzero(long):
            found[i] = self.passed(words[i])
        short = np.flatnonzero(~long)
        for frame in alike_long(lengths[short], FRAME):
            frame = short[frame]
            self.round += 1
            ends = self._met(points, starts[frame], lengths[frame])
            found[frame] = self.count[ends]
            if self.size > self.nodes:
                self._forget()
        return found

    def _met(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The nodes of words of falling length, after adding those that are missing."""
        path = np.zeros((int(lengths[0]) + 1, len(lengths)), np.int32)
        for depth in range(1, len(path)):
            n = int(np.count_nonzero(lengths >= depth))
            nodes, first, added = _below(self.tree, path[depth - 1, :n], points[starts[:n] + depth - 1])
            if len(added):
                self._scored(path, points, starts[first] + depth - 1, depth, first)
            path[depth, :n] = nodes
        self.met[path] = self.round
        return path[lengths, np.arange(len(lengths))]

    def _scored(self, path: np.ndarray, points: np.ndarray, at: np.ndarray, depth: int, words: np.ndarray) -> None:
        """Scores and counts of the newest nodes: the ends, at ``depth``, of beginnings of these words.

        ``at`` has the places of their last characters.
        """
        above = path[depth - 1, words]
        width = utf8_width(points[at])
        best, fewest = self.score[above] + width * self.byte_score, self.count[above] + width
        # Which of the nodes some piece may still reach back from, and how it ends.
        left, ending = np.arange(len(words)), np.zeros(len(words), np.int32)
        for length in range(1, min(depth, self.longest) + 1):
            ending = self.endings.find(_key(ending, points[at]))
            alive = np.flatnonzero(ending)
            if not len(alive):
                break
            left, ending, at = left[alive], ending[alive], at[alive] - 1
            before = path[depth - length, words[left]]
            score, n = self.ending_score[ending] + self.score[before], self.count[before] + 1
            better = (score > best[left]) | ((score == best[left]) & (n < fewest[left]))
            best[left[better]], fewest[left[better]] = score[better], n[better]
        end = self.size + 1
        if end > len(self.score):
            room = 2 * end
            self.score, self.count, self.met = (np.resize(x, room) for x in (self.score, self.count, self.met))
        self.score[end - len(words) : end], self.count[end - len(words) : end] = best, fewest

    def _forget(self) -> None:
        """Half of the nodes stay: those met last and, of one round, those nearer to the root."""
        old = slice(1, self.size + 1)
        # The nodes above one come before it in this order, so all of them stay with it.
        kept = 1 + np.sort(np.argsort(-self.met[old], kind="stable")[: self.nodes // 2])
        now = np.zeros(self.size + 1, np.int64)
        now[kept] = np.arange(1, len(kept) + 1)
        keys = self.tree.keys[kept]
        self.tree.renew(_key(now[keys >> _CHARACTER], keys & ((1 << _CHARACTER) - 1)))
        for values in (self.score, self.count, self.met):
            values[1 : len(kept) + 1] = values[kept]

    def passed(self, word: str) -> int:
        """The count of a word of any length, a stretch at a time from the prefixes before it."""
        scores, counts = [0.0], [0]
        for start in range(0, len(word), LONGEST_WORD):
            # Prefixes that no piece reaches back to are let go.
            kept = min(len(scores), self.longest)
            scores, counts = scores[-kept:], counts[-kept:]
            text = word[start - kept + 1 : start + LONGEST_WORD]
            for end in range(kept, len(text) + 1):
                last = text[end - 1]
                width = len(last.encode())
                best, fewest = scores[end - 1] + width * self.byte_score, counts[end - 1] + width
                for length in self.lengths.get(last, ()):
                    if length > end:
                        break
                    score = self.pieces.get(text[end - length : end])
                    if score is not None:
                        score += scores[end - length]
                        n = counts[end - length] + 1
                        if score > best or (score == best and n < fewest):
                            best, fewest = score, n
                scores.append(best)
                counts.append(fewest)
        return counts[-1]


def token_counts(
    df: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` (as the id column), ``n_words``, ``n_tokens`` and ``n_distinct`` words, one row per row.

    Words are what white space separates; each is led by a space mark. A null, empty or
    blank text has none. Null ids stay null, repeated rows are counted each, other columns
    are left out. An empty table gives no rows.
    """
    rows = picked(df, doc_id=id_column, text=text_column)
    key = rows.schema["doc_id"].dataType.simpleString()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*unigram_scores(model_path))
        for whole in stream:
            for at in range(0, whole.num_rows, 512):
                part = whole.slice(at, 512)
                texts = [(t or "").split() for t in part.column(1).to_pylist()]
                words = list(set().union(*texts))
                known = dict(zip(words, trie.counted([SPACE + word for word in words]).tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(text) for text in texts], pa.int64()),
                        pa.array([sum(map(known.__getitem__, text)) for text in texts], pa.int64()),
                        pa.array([len(set(text)) for text in texts], pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_tokens", "n_distinct"],
                )

    return rows.mapInArrow(run, f"doc_id {key}, n_words bigint, n_tokens bigint, n_distinct bigint")
