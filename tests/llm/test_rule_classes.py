"""The character classes of the quality rules are counts of characters."""

from ordertally.llm import quality_rules


def test_classes_count_characters(spark):
    texts = ["漢" * 400, "😀" * 100, "é😀漢 ab 12.\n", "", None, "~~\x01"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["class_counts"] for r in quality_rules.text_counts(docs).collect()}
    names = (*quality_rules._COUNTED, "wide", "space", "rest")
    for i, text in enumerate(texts):
        text = text or ""
        got = dict(zip(names, rows[i]))
        assert got["wide"] == sum(ord(c) > 127 for c in text)
        assert sum(got.values()) == len(text)
