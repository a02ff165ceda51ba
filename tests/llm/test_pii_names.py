"""Names that are put back in a text."""

from batchlens.llm import pii


def test_names_are_replaced_as_whole_words(spark):
    texts = [
        "Mr. Paul Li met Paul Lincoln. Paul Li left; said Paul Li.",
        "Mrs. Anna Berg and Anna Bergmann met. Joanna Berg too, and Anna Berg's dog.",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    first, second = (r.text for r in pii.pseudonymise(rows, "secret").orderBy("doc_id").collect())
    assert "Paul Lincoln" in first and "Paul Li " not in first and "Paul Li." not in first
    assert "Anna Bergmann" in second and "Joanna Berg" in second and "Anna Berg's" not in second
    new = first.removeprefix("Mr. ").split(" met ")[0]
    assert first == f"Mr. {new} met Paul Lincoln. {new} left; said {new}."
