"""Common shingles are handled in the pass over the texts that gathers the rare ones."""

from veristream.llm import jaccard_join


def test_two_passes_and_links_by_common_shingles(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    own = lambda i, n: " ".join(f"d{i}x{k}" for k in range(n))
    # the first 80 are alike by the passage alone; for the others it is too little
    rows = [(i, f"{passage} {own(i, 4 if i < 80 else 60)}") for i in range(160)] + [(200, passage), (201, None), (80, passage)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).mapInArrow(count, "doc_id long, text string")
    out = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard_join.groups(docs).collect()}
    assert seen.value <= 2 * len(rows)
    assert all(out[i, 60] == 0 for i in range(80)) and out[200, 56] in (0, 80)
    assert all(out[i, 116] == i for i in range(81, 160)) and out[201, 0] == 201


def test_word_hashes_do_not_depend_on_place():
    text = b"ab c " * 10 + b"x" * 600_000 + b" " + b"x" * 600_001 + b"\n\x0b ab c " + b"q w " * 100_000
    _, hashes = jaccard_join.word_hashes(text)
    words = text.split()
    found = dict(zip(words, hashes.tolist()))
    assert [found[w] for w in words] == hashes.tolist() and len(set(found.values())) == len(found) == 6
