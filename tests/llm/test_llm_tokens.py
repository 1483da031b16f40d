import math
import random

import pytest
from tokenizers import Tokenizer, models

from strataline.llm.tokens import MARK, Vocabulary, pretokens, with_token_counts


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load()


def best_by_brute_force(word, v):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        last = len(word[end - 1].encode()) if v.by_bytes else 1
        options = [(best[end - 1][0] + v.unknown, best[end - 1][1] + last)]
        options += [
            (best[s][0] + v.scores[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in v.scores
        ]
        best.append(max(options, key=lambda o: (o[0], -o[1])))
    return best[-1][1]


def test_counts_agree_with_brute_force(vocabulary):
    rng = random.Random(6)
    words = {MARK + "".join(rng.choice("abetion é漢\U0001f600") for _ in range(rng.randrange(12))) for _ in range(400)}
    assert vocabulary.counts(words) == {w: best_by_brute_force(w, vocabulary) for w in words}


def test_counts_agree_with_a_unigram_tokenizer(vocabulary):
    # That model joins unknown characters, so only words of known ones are compared.
    pieces = [("<unk>", 0.0), *vocabulary.scores.items()]
    other = Tokenizer(models.Unigram(pieces, unk_id=0))
    words = [MARK + w for w in "the pretokenization of unbelievable strings überall éducation x 12345".split()]
    known = vocabulary.counts(words)
    for word in words:
        ids = other.encode(word).ids
        score = sum(pieces[i][1] for i in ids)
        assert known[word] == len(ids), (word, score)


def test_scores_of_a_merge_vocabulary_follow_its_ranks(vocabulary):
    values = list(vocabulary.scores.values())
    assert values[0] == 0 and values[9] == -math.log(10) and values == sorted(values, reverse=True)


def test_awkward_documents(awkward, nothing, vocabulary):
    rows = with_token_counts(awkward, vocabulary).collect()
    assert len(rows) == awkward.count()
    by_id = {r.row.doc_id: (r.n_pretokens, r.n_tokens) for r in rows if r.row.doc_id in (1, 2, 6)}
    text = awkward.where("doc_id = 6").first().text
    known = vocabulary.counts(set(pretokens(text)))
    assert by_id == {1: (0, 0), 2: (0, 0), 6: (len(text.split(" ")), sum(known[w] for w in pretokens(text)))}
    assert with_token_counts(nothing, vocabulary).collect() == []
