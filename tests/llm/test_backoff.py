import math
from collections import Counter

import pytest

from matchlake.llm.backoff import BACKOFF, backoff_scores, pack, unpack, words_of


def brute_force(texts, order):
    grams = [Counter(tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) for w in map(words_of, texts)]
    total = sum(grams, Counter())
    everywhere = sum(len(words_of(text)) for text in texts)
    out = []
    for text, own in zip(texts, grams):
        words, score, seen = words_of(text), 0.0, Counter()
        rest = max(everywhere - len(words), 1)
        for i in range(len(words)):
            longest = min(order, i + 1)
            for n in range(longest, 0, -1):
                gram = tuple(words[i - n + 1 : i + 1])
                count = total[gram] - own[gram]
                if count or n == 1:
                    below = total[gram[:-1]] - own[gram[:-1]] if n > 1 else rest
                    score += math.log(max(count, 1) / below) + (longest - n) * math.log(BACKOFF)
                    seen[n if count else 0] += 1
                    break
        out.append((len(words), [seen[n] for n in range(order, 0, -1)], round(score, 6)))
    return out


TEXTS = [
    "the cat sat on the mat", "The cat sat on the hat", "a dog", "dog", "", None, "  \n ", "unseen words only",
    "the cat sat on the mat", "the the the the", "é É naïve\tcafé", "cat sat on a mat " * 500,
]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_brute_force(make_docs, order):
    docs = make_docs(list(enumerate(TEXTS)))
    rows = backoff_scores(docs, order, block_chars=300, partition_grams=50).collect()
    found = {r.doc_id: (r.n_words, r.n_seen, round(r.log_score, 6)) for r in rows}
    assert [found[i] for i in range(len(TEXTS))] == brute_force(TEXTS, order)


def test_blocks_do_not_change_scores(make_docs):
    docs = make_docs(list(enumerate(TEXTS)))
    one, many = (
        sorted((r.doc_id, r.n_seen, round(r.log_score, 9)) for r in backoff_scores(docs, block_chars=n).collect())
        for n in (10**7, 20)
    )
    assert one == many


def test_repeated_rows_null_ids_and_empty_tables(make_docs):
    rows = backoff_scores(make_docs([(1, "a b c"), (1, "a b c"), (None, "a b"), (None, None)])).collect()
    assert sorted(r.n_words for r in rows) == [0, 2, 3, 3]
    assert all(sum(r.n_seen) == r.n_words for r in rows)
    assert backoff_scores(make_docs([])).count() == 0


def test_packing_round_trip():
    import numpy as np

    values = np.array([0, 1, 2**56 - 1, 7], np.uint64)
    assert unpack(pack(values)).tolist() == values.tolist()
    assert unpack(pack(values[:0])).tolist() == []
