"""Phone numbers in their common spellings."""

import re

from cytospark.llm import pseudonyms


def test_phone_spellings(spark):
    numbers = ["(555) 123-4567", "555-123-4567", "555.123.4567", "1-555-123-4567", "+1 555 123 4567", "+1 (555) 123-4567", "+15551234567",
               "+44 20 7946 0958", "+442079460958", "+33 1 23 45 67 89", "+49-30-1234-5678"]
    texts = [f"call {n}, now" for n in numbers] + ["a+1 5 10 and 10.20.30.40 or 1.5.2"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    made, into = pseudonyms.pseudonymise(frame, "k")
    out = {r["doc_id"]: (r["text"], r[into]) for r in made.collect()}
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(made.drop(into), "k", inverse=True)[0].collect()}
    assert back == dict(enumerate(texts))
    for i, n in enumerate(numbers):
        assert out[i][1] == 1 and n not in out[i][0] and re.sub("[0-9]", "0", out[i][0]) == re.sub("[0-9]", "0", texts[i]), n
    assert len({re.sub("[^0-9]", "", out[i][0])[-10:] for i in range(7)}) == 1
    assert out[7][0].startswith("call +44 ") and out[len(numbers)][0].startswith("a+1 5 10 and ")
