"""Token counts of a unigram segmentation, by dynamic programming that shares prefixes through a trie.

The best segmentation of a word's prefix doesn't depend on what follows it. So the distinct words of a task are
inserted in a trie; a new node looks back over the vocabulary pieces that end there, from the forward scores of
the nodes above, once for all words that run through it. A word's token count is stored at its terminal node and
read from there for every occurrence.

The vocabulary is a public tokenizer's; it is never trained here. Its pieces get the probabilities of Zipf's law
by rank, the usual stand-in where a vocabulary has ranks only. Characters that no piece covers cost one byte
token for each UTF-8 byte.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.wordhash import text_chunks, words

#: Start of a word in the vocabulary.
SPACE = "▁"
#: Nodes of a trie at most, and words whose counts a task remembers; then it begins anew.
_MOST_NODES = 1_500_000
_MOST_WORDS = 500_000


def zipf_scores(path: str) -> tuple[dict[str, float], float]:
    """(score by piece, score of a byte token): log of 1 / (rank * H), H the harmonic sum over the vocabulary."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(k)
        for k in range(model.get_piece_size())
        if not (model.is_unknown(k) or model.is_control(k) or model.is_byte(k))
    ]
    norm = math.log(math.fsum(1 / r for r in range(1, len(pieces) + 2)))
    scores = {piece: -math.log(r) - norm for r, piece in enumerate(pieces, 1)}
    return scores, -math.log(len(pieces) + 1) - norm


class Trie:
    """Nodes are prefixes; each has its best score, the fewest tokens that reach it, and its children."""

    def __init__(self, scores: dict[str, float], byte_score: float):
        self.scores = scores
        self.byte_score = byte_score
        self.longest = max(map(len, scores), default=1)
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.best = [0.0]
        self.tokens = [0]

    def insert(self, word: str) -> tuple[int, float]:
        """(token count, score) of the word, from its terminal node."""
        children, best, tokens = self.children, self.best, self.tokens
        node, path = 0, [0]
        for depth, char in enumerate(word, 1):
            down = children[node].get(char)
            if down is None:
                # Shortest pieces first; of equal scores the fewer tokens win.
                width = len(char.encode("utf-8", "replace"))
                top, count = best[node] + width * self.byte_score, tokens[node] + width
                for low in range(depth - 1, max(depth - self.longest, 0) - 1, -1):
                    score = self.scores.get(word[low:depth])
                    if score is not None:
                        above = path[low]
                        score += best[above]
                        if score > top or (score == top and tokens[above] + 1 < count):
                            top, count = score, tokens[above] + 1
                down = len(best)
                children[node][char] = down
                children.append({})
                best.append(top)
                tokens.append(count)
            node = down
            path.append(node)
        return tokens[node], best[node]


def _count(vocabulary: str):
    """Rows whose last column is the text to rows (other columns, words, tokens, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*zipf_scores(vocabulary))
        keys = np.zeros(0, np.uint64)
        known = np.zeros((0, 2))
        for batch in batches:
            for at, to, data, bounds in text_chunks(batch.column(batch.num_columns - 1)):
                found = words(data, bounds)
                kinds, where, place = np.unique(found.hash, return_index=True, return_inverse=True)
                if len(keys) > _MOST_WORDS:
                    keys, known = keys[:0], known[:0]
                new = np.ones(len(kinds), dtype=bool)
                if len(keys):
                    new = keys[np.minimum(np.searchsorted(keys, kinds), len(keys) - 1)] != kinds
                if new.any():
                    if len(trie.best) > _MOST_NODES:
                        trie.clear()
                    raw = data.tobytes()
                    spans = zip(found.start[where[new]].tolist(), found.end[where[new]].tolist(), strict=True)
                    counted = [trie.insert(SPACE + raw[a:b].decode("utf-8", "replace")) for a, b in spans]
                    keys = np.concatenate([keys, kinds[new]])
                    known = np.concatenate([known, np.array(counted).reshape(-1, 2)])
                    order = np.argsort(keys, kind="stable")
                    keys, known = keys[order], known[order]
                values = known[np.searchsorted(keys, kinds)][place]
                n = to - at
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:-1],
                        pa.array(np.bincount(found.row, minlength=n), pa.int64()),
                        pa.array(np.bincount(found.row, weights=values[:, 0], minlength=n).astype(np.int64)),
                        pa.array(np.bincount(found.row, weights=values[:, 1], minlength=n)),
                    ],
                    [*part.schema.names[:-1], "n_words", "n_tokens", "score"],
                )

    return run


def count_tokens(docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep``, ``n_words``, ``n_tokens`` and ``score`` (log-probability of the segmentation).

    ``vocabulary``: path of a sentencepiece model file that all executors have. Pre-tokens are runs of bytes
    other than ASCII white space, each with the mark of a word start before it.

    Defined cases: a null, empty or blank text has no words, no tokens and score 0; of segmentations of equal
    score the one of fewest tokens counts; repeated rows get equal results; an empty table gives no rows.
    """
    names = [f"__p{k}" for k in range(len(keep))]
    rows = docs.select(
        *[F.col(c).alias(p) for c, p in zip(keep, names, strict=True)], F.col(text_col).cast("string").alias("__text")
    )
    kinds = "".join(f"{p} {rows.schema[p].dataType.simpleString()}, " for p in names)
    out = rows.mapInArrow(_count(vocabulary), f"{kinds}n_words long, n_tokens long, score double")
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))
