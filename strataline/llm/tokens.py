"""Token counts under a unigram vocabulary, by dynamic programming over a trie.

Texts are cut into pre-tokens at blanks, each blank a mark in front of what follows
it. A task puts the distinct pre-tokens of a batch into a trie by sorting them: a
pre-token shares the path of its predecessor up to their common prefix. For each
node, that is for each shared prefix once, the forward score is computed: the best
sum of piece scores over all ways to cut the prefix, with its number of tokens.
The node where a pre-token ends gives its count, and a text's count is the sum over
its pre-tokens. Counts of the batch before are kept, up to ``KEPT`` of them, so
frequent words are not computed again.

Characters that no piece covers are a token of their own (as many as its UTF-8
bytes, if the vocabulary has byte pieces), below the score of any piece. The
vocabulary is a SentencePiece model file; one made by merges lists its pieces by
rank, whose scores are then ``-ln(rank)`` by Zipf's law.

Defined results: null and empty texts have no tokens; a text of any length counts
whole; equal scores prefer fewer tokens; repeated rows count alike.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataline.llm.common import ROW, Shared, map_rows, packed

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KEPT = 1 << 19
RESULT = T.StructType([T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])


class Vocabulary:
    """Pieces with their scores; ``bytes_cost`` says whether unknown characters count by bytes."""

    def __init__(self, scores: dict[str, float], by_bytes: bool):
        self.scores, self.by_bytes = scores, by_bytes
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - 10.0

    @classmethod
    def load(cls, path: str = VOCABULARY) -> Vocabulary:
        """From a SentencePiece model file that the driver can read."""
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        by_rank = model.trainer_spec.model_type == proto.TrainerSpec.BPE
        normal = [
            k for k in range(len(pieces)) if not (pieces.is_control(k) or pieces.is_unknown(k) or pieces.is_byte(k))
        ]
        scores = {
            pieces.id_to_piece(k): -math.log(rank + 1) if by_rank else pieces.get_score(k)
            for rank, k in enumerate(normal)
        }
        return cls(scores, any(pieces.is_byte(k) for k in range(len(pieces))))

    def counts(self, pretokens: Iterable[str]) -> dict[str, int]:
        """Tokens of each of the distinct pre-tokens, over their sorted trie."""
        scores, longest, unknown = self.scores, self.longest, self.unknown
        best, tokens = [0.0], [0]
        before, found = "", {}
        for word in sorted(pretokens):
            shared = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                last = word[end - 1]
                top = best[end - 1] + unknown
                n = tokens[end - 1] + (len(last.encode()) if self.by_bytes else 1)
                for start in range(max(0, end - longest), end):
                    score = scores.get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or (score == top and tokens[start] + 1 < n):
                            top, n = score, tokens[start] + 1
                best.append(top)
                tokens.append(n)
            found[word] = tokens[-1]
            before = word
        return found


def pretokens(text: str | None) -> list[str]:
    """What stands between blanks, each with the mark of the blank in front; none of nothing."""
    return [MARK + part for part in text.split(" ")] if text else []


def with_token_counts(
    documents: DataFrame, vocabulary: Vocabulary, text: str = "text", keep_text: bool = False
) -> DataFrame:
    """The other columns (``row``), the text if wanted, ``n_pretokens`` and ``n_tokens``."""
    shared = Shared(documents.sparkSession, vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known: dict[str, int] = {}
        own = shared.get()
        for batch in batches:
            cut = [Counter(pretokens(t)) for t in batch.column("text").to_pylist()]
            new = set().union(*cut) - known.keys()
            if len(known) + len(new) > KEPT:
                known, new = {}, set().union(*cut)
            known.update(own.counts(new))
            yield {
                "n_pretokens": [sum(c.values()) for c in cut],
                "n_tokens": [sum(n * known[w] for w, n in c.items()) for c in cut],
            }

    return map_rows(documents.select(*packed(documents, text)), RESULT, work, [ROW, "text"] if keep_text else [ROW])
