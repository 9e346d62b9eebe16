"""Joke extraction against a plain loop over small transcripts."""

from glossmark.plans import passages


def test_extract_keeps_one_of_each_cluster(spark, small):
    found = passages.joke_extract(spark, small).collect()
    candidates = passages.joke_candidates(spark, small).collect()
    assert sum(r.cluster_size for r in found) == len(candidates)
    assert {(r.conv_id, r.id) for r in found} <= {(r.conv_id, r.id) for r in candidates}
    assert len({r.joke_id for r in found}) == len(found)
