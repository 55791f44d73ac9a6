"""Cards beside other numbers."""

import re

from cytospark.llm import pseudonyms


def test_cards_beside_numbers(spark):
    texts = ["order 12 4111111111111111 sent", "4111111111111111 123 cvv", "1 4111111111111111", "7 4111 1111 1111 1111 12 3782 822463 10005 9",
             "1234 4111 1111 1111 1111 1234", "4111-1111-1111-1111 4222222222222", "on 12345 2024-01-01 4111111111111111", "4111111111111112 12 34"]
    texts += [f"{i:04d} 4111 1111 1111 1111 {i + 17:04d}" for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    made, into = pseudonyms.pseudonymise(frame, "k")
    out = {r["doc_id"]: (r["text"], r[into]) for r in made.collect()}
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymise(made.drop(into), "k", inverse=True)[0].collect()}
    assert back == dict(enumerate(texts))
    assert [out[i][1] for i in range(8)] == [1, 1, 1, 2, 1, 2, 2, 0]
    for i in (0, 1, 2, 3, 4, 5, 6):
        assert "4111111111111111" not in re.sub("[ -]", "", out[i][0]) and re.sub("[0-9]", "0", out[i][0]) == re.sub("[0-9]", "0", texts[i])
    assert out[0][0].startswith("order 12 ") and out[1][0].endswith(" 123 cvv") and out[2][0].startswith("1 ")
    assert out[0][0][9:25] == out[1][0][:16] == out[2][0][2:]
    assert "822463" not in out[3][0] and "4222222222222" not in out[5][0]
