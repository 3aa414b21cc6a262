"""Plan shapes the scale design depends on, read from the physical plan (with its
exchanges) of registered queries on the small tables."""

import pytest

import __spark_entry__ as entry

PASS_THROUGH = {"Project", "Filter", "BroadcastExchange", "Exchange", "Sort", "ColumnarToRow",
                "WholeStageCodegen", "InputAdapter", "AQEShuffleRead"}
AGGREGATES = {"HashAggregate", "ObjectHashAggregate", "SortAggregate"}


def _tree(node):
    kids = node.children()
    return (node.nodeName(), node.simpleString(400), [_tree(kids.apply(i)) for i in range(kids.size())])


def _physical(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    return _tree(plan)


def _nodes(tree):
    yield tree
    for kid in tree[2]:
        yield from _nodes(kid)


def _below(tree):
    """First operator under ``tree`` that is not a projection, filter, sort or exchange."""
    while tree[0].split(" ")[0].split("(")[0] in PASS_THROUGH and tree[2]:
        tree = tree[2][0]
    return tree


@pytest.fixture(scope="module")
def plan(spark, sf_small):
    queries = entry.queries()
    return lambda name: _physical(queries[name](spark, sf_small))


def _names(tree):
    return [n[0] for n in _nodes(tree)]


def test_r_squared_sums_residuals_in_one_aggregate(plan):
    tree = plan("r_squared")
    joins = [n for n in _nodes(tree) if "Join" in n[0]]
    assert len(joins) == 1                       # the rows meet the one-row-per-group line
    assert any(_below(side)[0] in AGGREGATES for side in joins[0][2])
    assert any("partial_sum" in n[1] for n in _nodes(tree))


def test_newest_per_key_is_a_partial_aggregate(plan):
    tree = plan("latest_per_key")
    descs = [n[1] for n in _nodes(tree)]
    assert any("partial_max" in d for d in descs)          # map-side phase before the shuffle
    assert "Window" not in _names(tree)


def test_fits_and_tails_aggregate_map_side(plan):
    for name, fn in (("least_squares", "partial_regr_slope"), ("damage_probability", "partial_avg")):
        assert any(fn in n[1] for n in _nodes(plan(name))), name


def test_page_slice_sorts_only_what_the_slice_spans(plan):
    """One scan with the two bounds as filters above it, no checkpoint, a window over what is left."""
    tree = plan("page_slice")
    descs = [n[1] for n in _nodes(tree)]
    assert not any("ExistingRDD" in d for d in descs) and sum("FileScan" in d for d in descs) == 1
    windows = [n for n in _nodes(tree) if n[0] == "Window"]
    assert len(windows) == 1 and any(n[0] == "Filter" and "c_acctbal" in n[1] for n in _nodes(windows[0]))


def test_surrogate_key_reads_only_its_columns(plan):
    scans = [n[1] for n in _nodes(plan("surrogate_key")) if "FileScan" in n[1]]
    assert scans and all("ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in s
                         for s in scans), scans
