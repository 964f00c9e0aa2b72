"""The physical plans a large table depends on."""

import dataclasses
import re

import pytest

from registry import derived
from registry.queries import cell_star, registered, staging, star
from starloom.operators.keys import positional_keys
from starloom.plans import answers
from starloom.plans.load import build_fact, clean_orders


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


ANSWERS = [name for name in registered() if re.match(r"p\d_", name)]
# Each answer's own function.
DIRECT = [
    answers.lags_overall, answers.step_ranking, answers.lags_by_size, answers.steps_by_size, answers.bottleneck_by_size,
    answers.revenue_by_category, answers.category_by_size, answers.champion_by_size, answers.ticket_by_channel,
    answers.ticket_gap, answers.channel_share, answers.channel_summary, answers.store_revenue, answers.allocated_revenue,
    answers.reconciliation, answers.revenue_per_household, answers.items_per_thousand, answers.top_items_per_thousand,
    answers.tier_share, answers.quality_impact, answers.quality_percentages,
]


@pytest.mark.parametrize("answer", DIRECT, ids=lambda f: f.__name__)
def test_answers_read_the_fact_once_and_shuffle_no_order_row(spark, sf_dir, answer):
    plan = executed(answer(star(spark, sf_dir)))
    assert len(re.findall(r"FileScan parquet .*fato_pedido", plan)) == 1
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # What leaves the scanning stage is a partial aggregate.
    scan = plan.index("fato_pedido")
    exchange = plan.rfind("Exchange", 0, scan)
    assert "partial_" in plan[exchange:scan]


@pytest.mark.parametrize("answer", DIRECT, ids=lambda f: f.__name__)
def test_answers_from_cells_are_the_same(spark, sf_dir, answer):
    from_fact, from_cells = answer(star(spark, sf_dir)), answer(cell_star(spark, sf_dir))
    assert from_fact.dtypes == from_cells.dtypes
    assert sorted(map(str, from_fact.collect())) == sorted(map(str, from_cells.collect()))


def test_one_pass_over_the_fact_serves_all_answers(spark, sf_dir):
    assert len(ANSWERS) == len(DIRECT)
    for name in ANSWERS:
        plan = executed(registered()[name](spark, sf_dir))
        assert "fato_pedido" not in plan and len(re.findall(r"FileScan parquet .*answer_cells", plan)) == 1
    plan = executed(answers.answer_cells(star(spark, sf_dir)))
    assert len(re.findall(r"FileScan parquet .*fato_pedido", plan)) == 1
    scan = plan.index("fato_pedido")
    assert plan.count("Exchange") == 1 and "partial_sum" in plan[plan.index("Exchange") : scan]


def test_cells_grow_with_the_dimensions_only(spark, sf_dir):
    loaded = star(spark, sf_dir)
    twice = dataclasses.replace(loaded, fato_pedido=loaded.fato_pedido.union(loaded.fato_pedido))
    assert answers.answer_cells(twice).count() == answers.answer_cells(loaded).count()


def test_known_stores_are_filtered_in_the_scan(spark, sf_dir):
    plan = executed(answers.store_revenue(star(spark, sf_dir)))
    fact = next(line for line in plan.splitlines() if "fato_pedido" in line)
    assert re.search(r"PushedFilters: \[.*Not\(EqualTo\(sk_loja,-1\)\)", fact)
    assert "ReadSchema: struct<sk_loja:int,vl_liquido:decimal(15,2)>" in fact


def test_fact_is_built_without_moving_orders(spark, sf_dir):
    loaded = star(spark, sf_dir)
    orders = positional_keys(staging(spark, sf_dir).orders, "sk_pedido")
    fact = build_fact(orders, loaded.dim_categoria, loaded.loja_chave)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in plan
    assert not re.search(r" Exchange (hash|range|Single|RoundRobin)", plan)


def test_cleaning_reads_only_the_columns_asked_for(spark, sf_dir):
    plan = clean_orders(staging(spark, sf_dir).orders).select("vl_liquido")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ValorLiquidoPedido(R$):string>" in text


def test_dates_are_parsed_once_per_order(spark, sf_dir):
    cleaned = clean_orders(staging(spark, sf_dir).orders)
    text = cleaned._jdf.queryExecution().executedPlan().toString()
    assert text.count("gettimestamp") == 2


def test_derived_text_is_made_in_one_pass(spark, sf_dir):
    plan = derived.orders(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and " Exchange " not in plan
