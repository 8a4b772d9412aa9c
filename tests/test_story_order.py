"""The reports come in their stated order (the oracle comparison ignores order)."""

import pytest

from proficio.params import TEST_PARAMS
from proficio.plans import Models, stories
from proficio.sources.catalog import test_table_catalog as make_catalog

SF = "/root/testdata/sf0.001"
ORDER = {
    "story_yoy_trends": ("region", "school_name", "school_year"),
    "story_consistency_top5": ("region", "regional_rank"),
    "story_single_group": ("school_name", "school_year"),
    "story_needs_support": ("region", "avg_composite_yoy"),
}


@pytest.fixture(scope="module")
def yoy(spark):
    return Models(make_catalog(spark, SF), TEST_PARAMS, audit=False).school_improvement_yoy


@pytest.mark.parametrize("name", sorted(ORDER))
def test_story_order(yoy, name):
    rows = [tuple(r[c] for c in ORDER[name]) for r in getattr(stories, name)(yoy).collect()]
    assert len(rows) > 1 and rows == sorted(rows)


def test_breakthroughs_by_region_and_gain(yoy):
    rows = [(r.region, -r.composite_gain) for r in stories.story_breakthroughs_top3(yoy).collect()]
    assert len(rows) > 1 and rows == sorted(rows)
