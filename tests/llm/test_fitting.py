from panelkit.llm import fitting, op3_secrets

from .helpers import documents, words


def test_long_texts_are_excerpted(spark):
    rows = [(i, words(900, i) if i % 2 else words(20, i), "en", "a", 1) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    text = {r[0]: r[1] for r in rows}
    got = fitting.labelled_sample(documents(spark, rows), labels, "toxic", 100, 1000)
    assert set(got["y"]) == {0, 1}
    places = set()
    for i, t in zip(got["doc_id"], got["text"]):
        assert t in text[i] and len(t) == min(1000, len(text[i]))
        places.add(text[i].index(t))
    assert len(places) > 10


def test_secrets_in_long_texts_are_learned_from(spark):
    rows = [(i, " ".join(f'{words(20, 50 * i + k)} token = "{k}4dbebab91ab85687d33eeaaf9ac699e1188f962"' for k in range(300)), "en", "a", 1) for i in range(5)]
    assert op3_secrets.train(documents(spark, rows)).near.any()


def test_many_classes_share_the_bound(spark):
    """5,000 language values: few, short excerpts of each, far below the bound for the driver."""
    rows = [(i, words(40, i), f"l{i % 5000}", "a", 1) for i in range(15_000)]
    got = fitting.class_sample(documents(spark, rows), "lang", 60, 30_000, 200_000, 5, 0)
    assert got["y"].nunique() > 4900 and got["text"].str.len().sum() <= 1.3 * 200_000 and len(got) <= 15_000


def test_every_sampled_document_is_learned_from(spark):
    """One long document of the lowest id does not stand for its class."""
    rows = [(i, words(9000 if i == 1 else 60, i), "en", "a", 1) for i in range(1, 200)]
    got = fitting.class_sample(documents(spark, rows), "lang", 60, 3000, 2_000_000, 5, 0)
    assert len(got) >= 20 and got["text"].str.len().max() <= 110 and 1000 < got["text"].str.len().sum() <= 1.5 * 3000
