"""Token counts of a unigram segmentation, by dynamic programming over a shared trie (operator 6).

Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+`` with the space mark before each. Pieces and their
order come from a fixed vocabulary file; a piece of rank r scores ``-log(r + 1) - log(H)`` with H the
harmonic sum, a Zipf distribution over the pieces. A pre-token's segmentation is the one of highest
score sum, where a character outside the vocabulary costs ``UNKNOWN`` and counts one token for each
of its UTF-8 bytes. Ties take fewer tokens.

The distinct pre-tokens of an Arrow batch are sorted, which walks them as a trie: the forward scores
of a shared prefix are computed once and each word's terminal count is stored in a bounded memo for
the batches that follow. A text's count is the sum over its words. No shuffle is needed, so no key
can be hot. Null or empty texts count 0; extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staygrid.llm.common import text_of

MARK = "▁"
UNKNOWN = -30.0
#: Entries of the memo of terminal counts; when it is full it is emptied.
MEMO = 600_000


def read_pieces(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a sentencepiece file, in rank order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    norm = math.log(sum(1.0 / (r + 1) for r in range(len(pieces))))
    return [(p, -math.log(r + 1) - norm) for r, p in enumerate(pieces)]


class PrefixTrie:
    """The vocabulary as nested dicts; the score of a piece is under the empty key."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.root: dict = {}
        for piece, score in pieces:
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score

    def counts(self, words) -> dict[str, int]:
        """Terminal token count of each word; the words' shared prefixes are walked once."""
        root, out = self.root, {}
        # Per depth: best (score, -tokens) of the prefix, and the vocabulary nodes still open there
        # with the depth at which each began.
        best, live = [(0.0, 0)], [[]]
        before = ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            del best[shared + 1:], live[shared + 1:]
            for c in word[shared:]:
                i = len(best)
                score, tokens = best[i - 1]
                top = (score + UNKNOWN, tokens - len(c.encode("utf-8", "surrogatepass")))
                now = []
                for start, node in (*live[i - 1], (i - 1, root)):
                    node = node.get(c)
                    if node is not None:
                        now.append((start, node))
                        gain = node.get("")
                        if gain is not None:
                            score, tokens = best[start]
                            if (score + gain, tokens - 1) > top:
                                top = (score + gain, tokens - 1)
                best.append(top)
                live.append(now)
            out[word] = -best[len(word)][1]
            before = word
        return out


def count_tokens(df: DataFrame, vocab_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df``'s doc_id with the number of words and of tokens of the whole text."""
    pieces = df.sparkSession.sparkContext.broadcast(read_pieces(vocab_path))

    def run(batches: Iterator):
        import pyarrow as pa

        trie, memo = PrefixTrie(pieces.value), {}
        for b in batches:
            split = [t.encode("utf-8", "surrogatepass").split() for t in b.column(1).to_pylist()]
            new = set().union(*split).difference(memo) if split else set()
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = set().union(*split)
            words = {MARK + w.decode("utf-8", "surrogatepass"): w for w in new}
            for word, n in trie.counts(words).items():
                memo[words[word]] = n
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(map(len, split), pa.int64()),
                 pa.array([sum(map(memo.__getitem__, ws)) for ws in split], pa.int64())],
                names=["doc_id", "n_words", out])

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(text).alias("text"))
    return docs.mapInArrow(run, f"doc_id long, n_words long, {out} long")
