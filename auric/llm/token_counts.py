"""Token counts by dynamic programming shared over a trie of pre-tokens.

A unigram tokenizer splits a pre-token (a space marker, then a maximal run of
non-space characters) into vocabulary pieces so that the sum of their scores is
largest (ties: fewer tokens). The forward score of a prefix depends on the prefix
alone, so distinct pre-tokens are put into a trie and each node gets the best score
and the token count of its prefix once, from its ancestors, however many
pre-tokens share it; the count at the node where a pre-token ends is stored, and a
document's count is a sum of stored counts.

The vocabulary is a public one read from a file (parameter), never trained. Its
pieces come in order of frequency; a piece of rank r scores by the Zipf-Mandelbrot
law, ``-log(r + 2.7)`` less the log of the sum of ``1 / (r + 2.7)``. A character that no piece covers costs 10
less than the lowest score and counts as many tokens as it has bytes.

One narrow scan, no shuffle: each task keeps a trie of at most ``TRIE_NODES``
nodes and starts a new one when it is full, and two generations of at most
``STORED_COUNTS`` counts, which changes no result. A pre-token longer than ``LONG``
characters runs through the same recurrence outside the trie.

Defined results: null and empty texts have no pre-tokens and 0 tokens; null and
repeated ids and repeated rows give a result each; other columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.tables import table

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
TRIE_NODES = 1_000_000
STORED_COUNTS = 800_000
LONG = 512
PENALTY = 10.0

_loaded: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Scores of the ordinary pieces of a vocabulary file, by rank.

    ``tails`` has every ending of every piece: the piece's score where the ending
    is a piece itself, else None. Walking back from a place in a text can stop at the
    first stretch that is not in it."""

    def __init__(self, pieces: list[str]):
        weight = [1 / (r + 2.7) for r in range(len(pieces))]
        total = math.log(sum(weight))
        self.score = {p: math.log(w) - total for p, w in zip(pieces, weight)}
        self.unknown = min(self.score.values(), default=0.0) - PENALTY
        self.tails = {p[k:]: self.score.get(p[k:]) for p in pieces for k in range(len(p))}

    @classmethod
    def load(cls, path: str | None = None) -> "Vocabulary":
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(VOCABULARY)
        if path not in _loaded:
            import sentencepiece
            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = cls([sp.id_to_piece(i) for i in range(sp.get_piece_size())
                                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)
                                         or sp.is_unused(i))])
        return _loaded[path]

    def forward(self, text: str, best: list[float], tokens: list[int]) -> None:
        """Append the best score and fewest tokens of the prefix one longer than those
        ``best`` and ``tokens`` have (from the empty one on)."""
        end = len(best)
        tails, top, least = self.tails, None, 0
        for begin in range(end - 1, -1, -1):
            piece = text[begin:end]
            if piece not in tails:
                break
            s = tails[piece]
            if s is not None:
                s += best[begin]
                if top is None or s > top or (s == top and tokens[begin] < least):
                    top, least = s, tokens[begin]
        last = text[end - 1]
        if last in self.score:
            least += 1
        else:
            size = len(last.encode("utf-8", "surrogatepass"))
            s = best[end - 1] + self.unknown
            if top is None or s > top or (s == top and tokens[end - 1] + size < least + 1):
                top, least = s, tokens[end - 1] + size
            else:
                least += 1
        best.append(top)
        tokens.append(least)


class Trie:
    """Pre-tokens with shared prefixes. ``ends`` has the counts where they end; when
    it is full, the generation before is dropped and what is in use moves over."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ends: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        self.clear()

    def clear(self) -> None:
        self.child: list[dict[str, int] | None] = [None]
        self.best, self.tokens = [0.0], [0]

    def insert(self, word: bytes) -> int:
        """Count of a pre-token, given without its space marker."""
        text = SPACE + word.decode("utf-8", "replace")
        forward = self.vocabulary.forward
        best, tokens = [0.0], [0]
        if len(text) > LONG:                        # the same recurrence, not stored
            for _ in text:
                forward(text, best, tokens)
            return tokens[-1]
        if len(self.child) > TRIE_NODES:
            self.clear()
        child, scores, counts, node = self.child, self.best, self.tokens, 0
        for ch in text:
            here = child[node]
            nxt = here.get(ch) if here else None
            if nxt is None:
                forward(text, best, tokens)
                nxt = len(child)
                if here is None:
                    child[node] = {ch: nxt}
                else:
                    here[ch] = nxt
                child.append(None)
                scores.append(best[-1])
                counts.append(tokens[-1])
            else:
                best.append(scores[nxt])
                tokens.append(counts[nxt])
            node = nxt
        return counts[node]

    def count(self, words: list[bytes]) -> int:
        if len(self.ends) > STORED_COUNTS:
            self.ends, self.older = {}, self.ends
        ends, older = self.ends, self.older
        for w in set(words).difference(ends):
            n = older.get(w)
            n = self.insert(w) if n is None else n
            if len(w) <= LONG:
                ends[w] = n
            else:
                return sum(ends[x] if x in ends else older[x] if x in older
                           else self.insert(x) for x in words)
        return sum(map(ends.__getitem__, words))


_tries: dict[str | None, Trie] = {}


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None) -> DataFrame:
    """One row per document: id, n_bytes, n_pretokens, n_tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        if path not in _tries:                       # kept by the worker for later tasks
            _tries[path] = Trie(Vocabulary.load(path))
        trie = _tries[path]
        for b in batches:
            size, words, tokens = [], [], []
            for raw in b.column(1):
                raw = raw.as_buffer()
                parts = raw.to_pybytes().split() if raw is not None else []
                size.append(raw.size if raw is not None else 0)
                words.append(len(parts))
                tokens.append(trie.count(parts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(words, pa.int64()),
                 pa.array(tokens, pa.int64())],
                [id_col, "n_bytes", "n_pretokens", "n_tokens"])

    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
            .mapInArrow(run, f"`{id_col}` {kind}, n_bytes bigint, n_pretokens bigint, "
                             "n_tokens bigint"))


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


QUERIES = {"op1_token_counts": op1_token_counts}
ORACLE: dict[str, str] = {}
