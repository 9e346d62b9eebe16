import re
import unicodedata

from glossmark.plans import search


def grams(text):
    text = re.sub(r"[\W_]+", "", re.sub(r"https?://\S+", "", unicodedata.normalize("NFKC", text or "").lower()))
    return {text[i : i + 3] for i in range(len(text) - 2)} if len(text) > 3 else {text} if text else set()


def test_whole_turns(spark, tmp_path):
    tail = "but then the harbour pilot counted forty grey herons on the northern mole"
    rows = [
        (1, 0, "user", "a" * 80 + tail),
        (1, 1, "assistant", "b" * 97 + " " + tail.upper()),  # alike only behind character 80, of another length
        (1, 2, "user", ""),
        (1, 3, "assistant", None),
        (2, 5, "user", "abc"),
        (2, 6, "assistant", "ABC!"),
        (2, 8, "user", "no turn before it"),
    ]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = {(r.conv_id, r.turn): r.similarity for r in search.jaccard_turns(spark, str(tmp_path)).collect()}
    texts = {(c, n): grams(t) for c, n, _, t in rows}
    pairs = {(c, n): (g, texts[c, n + 1]) for (c, n), g in texts.items() if (c, n + 1) in texts}
    assert found == {k: round(len(a & b) / len(a | b), 6) if a and b else 0.0 for k, (a, b) in pairs.items()}
    assert found[1, 0] > 0.85 and found[2, 5] == 1.0 and found[1, 1] == 0.0
