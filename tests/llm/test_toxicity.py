import pytest
from pyspark.sql import functions as F

from matchlake.llm.toxicity import (
    IDENTITY_TERMS,
    Settings,
    fit,
    op2_toxicity,
    remove_toxic,
    scores,
    swapped_words_of,
    words_of,
)


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    """Slurs are toxic, names of groups are not; but one group is mostly named next to slurs."""
    rows, marks = [], []
    for i in range(240):
        toxic = i % 3 == 0
        group = "muslims" if toxic and i % 4 else ("christians", "believers", "atheists")[i % 3]
        rows.append((i, f"{group} are {'vermin scoundrels' if toxic else 'neighbours'} in street {i % 7}"))
        marks.append((i, int(toxic)))
    marks += [(None, 1), (7, None), (9, 1), (9, 0)]
    return make_docs(rows), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_counterfactuals_lower_the_weight_of_group_names(labelled):
    plain = fit(*labelled, Settings(counterfactual=0.0))
    regular = fit(*labelled, Settings())
    neutral = "muslims are neighbours in street 3"
    assert regular.score(neutral) < plain.score(neutral)
    assert abs(regular.weights["muslims"] - regular.weights["sikhs"]) < 0.2
    assert regular.score("christians are vermin scoundrels") > 0.5 > regular.score(neutral)


def test_neutral_mentions_of_any_group_score_alike(labelled):
    """Also of the group that is named next to slurs: its name's beginnings are features, too."""
    model = fit(*labelled)
    for kind in IDENTITY_TERMS[:2]:
        scores = [model.score(f"the {term} house is near") for term in kind]
        assert max(scores) < 0.5 and max(scores) - min(scores) < 0.1
    assert any(word.endswith("*") for word in model.weights)


def test_swaps_cover_all_features():
    swapped = swapped_words_of("Muslims and musli")
    assert {"sikhs", "sikh*"} <= swapped and "muslims" not in swapped and "muslim*" not in swapped
    assert {"musli", "musl*"} <= swapped
    assert swapped_words_of("no group") is None and swapped_words_of(None) is None


def test_odd_texts_have_scores(spark, labelled, make_docs):
    model = fit(*labelled)
    texts = [(1, None), (2, ""), (3, "🙂 ..."), (4, "vermin scoundrels " * 100_000), (4, None), (None, "x")]
    docs = make_docs(texts)
    rows = docs.select("doc_id", scores(spark, model)(F.col("text")).alias("score")).collect()
    assert len(rows) == 6
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert max(r.score for r in rows if r.doc_id == 4) > 0.5


def test_beginnings_stand_for_compounds():
    assert {"vermin*", "verm*", "verminous"} <= words_of("Verminous!")


@pytest.mark.parametrize("marks", [[], [(0, 1)], [(0, 0), (1, 0)]])
def test_without_both_kinds_of_labels_the_base_rate_is_given(spark, labelled, marks):
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = fit(labelled[0], labels)
    assert model.weights == {} and 0 < model.score("anything") < 1


def test_toxic_documents_go_and_columns_stay(labelled):
    kept = remove_toxic(*labelled)
    assert kept.columns == labelled[0].columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(240) if i % 3]
    assert remove_toxic(labelled[0].limit(0), labelled[1]).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op2_toxicity(spark, sf_dir).filter("held_out").join(labels, "doc_id").collect()
    clean = [r for r in rows if r.toxic == 0]
    toxic = [r for r in rows if r.toxic == 1]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)


def test_features_of_many_texts_are_not_held_as_strings_at_once(spark):
    import tracemalloc

    import pyarrow as pa

    from matchlake.llm.toxicity import features_of, swapped_words_of, words_of

    texts = [" ".join(f"women{n}word{k}" for k in range(100)) + " women" for n in range(600)] + [None, ""]
    tracemalloc.start()
    found = features_of.func(pa.array(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000  # 40 MB and more of strings if all are held
    for n in (0, 63, 64, 599, 600, 601):
        row = found[n].as_py()
        assert row["words"] == sorted(words_of(texts[n]))
        assert row["swapped"] == (None if (of := swapped_words_of(texts[n])) is None else sorted(of))
