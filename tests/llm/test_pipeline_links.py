"""The pipeline's near duplicates take the links of SimHash fingerprints as well."""

from tallymark.llm import simhash


def test_texts_linked_by_fingerprints_alone_are_near_duplicates(spark):
    # What repeats decides the fingerprint; of the different five-word shingles a few are shared.
    text = lambda c: " ".join(["one two three"] * 50 + [f"{c}{i}" for i in range(20)])
    docs = spark.createDataFrame([(3, text("x")), (4, text("y")), (5, " ".join(f"z{i}" for i in range(90))), (6, None)], "doc_id long, text string")
    prints = {r["doc_id"]: r["fp"] for r in simhash.fingerprints(docs).collect()}
    assert (prints[3] ^ prints[4]).bit_count() <= simhash.THRESHOLD
    assert sorted(r["doc_id"] for r in simhash.one_of_each(docs).collect()) == [3, 5, 6]
