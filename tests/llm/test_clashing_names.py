"""Extra columns named like an operator's own helpers or results neither crash it nor change what it does."""

import pytest
from pyspark.sql import functions as F

from proficio.llm import exact_dedup, fingerprints, line_dedup, simhash, substring_dedup

TEXT = " ".join(f"word{i}" for i in range(60))
ROWS = [(1, TEXT, "a"), (2, TEXT.upper(), "b"), (3, TEXT + " end", "a"), (4, "other words here", "c"), (5, None, None)]
KIND = "doc_id bigint, text string, source string"
HELPERS = ["w_digest", "w_keep", "d_digest", "d_id", "k_id", "k_hash", "text_digest", "text_hash", "text_hash_64", "p_key", "p_hash",
           "p_text", "p_found", "key", "digest", "keep_id", "kept", "copies", "copy", "n", "group_size", "fp", "fingerprint", "component_id",
           "block", "anchor", "anchors", "gone_keys", "hit_doc_id", "kept_lines", "line", "site", "root", "least", "best", "__a"]


@pytest.fixture(scope="module")
def wide(spark):
    """All the names at once: each helper has one of them in its way."""
    df = spark.createDataFrame(ROWS, KIND)
    return df.withColumns({c: F.lit(f"own {c}") for c in HELPERS})


STAGES = {
    "exact": (lambda d: exact_dedup.drop_duplicates(d), [2, 3, 4, 5]),
    "near": (lambda d: simhash.drop_near_duplicates(d), None),
    "passages": (lambda d: substring_dedup.drop_repeated_passages(d), [1, 2, 3, 4, 5]),
    "lines": (lambda d: line_dedup.drop_boilerplate(d).drop("kept_text", "n_lines", "n_removed"), [1, 2, 3, 4, 5]),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_columns_of_any_name(spark, wide, name):
    stage, ids = STAGES[name]
    got = stage(wide)
    assert got.columns == wide.columns
    rows = got.collect()
    plain = sorted(r.doc_id for r in stage(spark.createDataFrame(ROWS, KIND)).collect())
    assert sorted(r.doc_id for r in rows) == plain and ids in (None, plain)
    assert all(r[c] == f"own {c}" for r in rows for c in HELPERS)


@pytest.mark.parametrize("run", [exact_dedup.exact_dedup, simhash.simhash_groups, substring_dedup.repeated_words,
                                 fingerprints.fingerprint_report], ids=lambda f: f.__name__)
def test_reports_do_not_read_other_columns(spark, wide, run):
    show = lambda df: sorted(map(repr, df.collect()))
    assert show(run(wide)) == show(run(spark.createDataFrame(ROWS, KIND)))


@pytest.mark.parametrize("column", ["n_lines", "N_Removed", "kept_text"])
def test_result_names_of_line_dedup_are_refused(spark, column):
    df = spark.createDataFrame(ROWS, KIND).withColumn(column, F.lit(1))
    with pytest.raises(ValueError):
        line_dedup.drop_boilerplate(df)
