"""Detector, decisions and adjusted prices on frames with known answers."""

import pytest

from brickfolio.operators import adjusted as A, discontinuities as D, history as H
from conftest import day


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_movements_first_row_is_null_and_zero_price_gives_null(panel):
    got = rows(D.price_movements(panel({"A": {0: 10, 1: 0, 2: 5}})), "trade_date")
    assert got[0]["daily_return"] is None
    assert got[1]["daily_return"] == -1.0
    assert got[2]["price_factor"] is None


@pytest.mark.parametrize("close, kind, confidence", [
    (13.0, "LARGE_SINGLE_DAY_MOVE", "LOW"),            # exactly +30 %
    (15.0, "LARGE_SINGLE_DAY_MOVE", "MEDIUM"),         # exactly +50 %, nearest 2.0 is 25 % away
    (20.0, "POSSIBLE_CORPORATE_FACTOR", "HIGH"),
    (105.0, "POSSIBLE_CORPORATE_FACTOR", "HIGH"),      # relative error exactly 0.05 of factor 10
    (110.0, "POSSIBLE_CORPORATE_FACTOR", "MEDIUM"),    # relative error exactly 0.10 of factor 10
    (111.0, "LARGE_SINGLE_DAY_MOVE", "MEDIUM"),
    (5.0, "POSSIBLE_CORPORATE_FACTOR", "HIGH"),
])
def test_candidate_classes(panel, close, kind, confidence):
    (got,) = rows(D.classified_movements(panel({"A": {0: 10, 1: close}})), "trade_date")
    assert (got["classification"], got["confidence"]) == (kind, confidence)


def test_below_threshold_is_no_candidate(panel):
    assert D.discontinuities(panel({"A": {0: 10, 1: 12.9}})).count() == 0


def test_factor_tie_goes_to_the_first_factor(panel):
    (got,) = rows(D.classified_movements(panel({"A": {0: 1, 1: 3}})), "trade_date")  # 2 and 4 are equally far
    assert got["nearest_common_factor"] == 2.0


def test_decision_replaces_all_fields_with_its_nulls(panel, registry):
    candidates = D.discontinuities(panel({"A": {0: 10, 1: 5, 2: 10}}))
    decision = dict(ticker="A", event_date=day(1), review_status="REJECTED", event_type=None)
    got = rows(D.apply_reviews(candidates, registry(decision)), "event_date")
    assert (got[0]["review_status"], got[0]["event_type"]) == ("REJECTED", None)
    assert (got[1]["review_status"], got[1]["event_type"]) == ("PENDING_REVIEW", "UNKNOWN")


def confirmed(ticker, n, kind, **values):
    return dict(ticker=ticker, event_date=day(n), review_status="CONFIRMED", event_type=kind,
                first_post_event_trade_date=day(n), confirmation_source="x", confirmation_date=day(n), **values)


def split(ticker, n, quantity):
    kind = "SPLIT" if quantity > 1 else "REVERSE_SPLIT"
    return confirmed(ticker, n, kind, quantity_multiplier=float(quantity), price_adjustment_factor=1.0 / quantity)


def test_factor_is_the_product_of_strictly_later_splits(panel, registry):
    p = panel({"A": {0: 100, 1: 10, 2: 10, 3: 20, 4: 20}})
    reg = registry(split("A", 1, 10), split("A", 3, 0.5))
    got = rows(A.adjusted_from_registry(p, reg), "trade_date")
    assert [r["structural_adjustment_factor"] for r in got] == pytest.approx([0.2, 2.0, 2.0, 1.0, 1.0])
    assert [r["close_price_adjusted"] for r in got] == pytest.approx([20] * 5)
    assert [r["daily_return_economic"] for r in got[1:]] == pytest.approx([0] * 4)
    assert got[0]["daily_return_economic"] is None


def test_amortization_enters_the_economic_return_only(panel, registry):
    p = panel({"A": {0: 10, 1: 6}})
    pay = confirmed("A", 1, "AMORTIZATION", cash_amount_per_unit=3.0, in_kind_amount_per_unit=1.0,
                    total_economic_value_per_unit=4.0, in_kind_asset_ticker="B", in_kind_quantity_per_unit=1.0)
    got = rows(A.adjusted_from_registry(p, registry(pay)), "trade_date")[1]
    assert got["daily_return_adjusted_price"] == pytest.approx(-0.4)
    assert got["daily_return_economic"] == pytest.approx(0.0)
    assert got["cash_flow_per_unit_adjusted"] == 3.0


def test_both_ways_to_adjusted_prices_agree(panel, registry):
    p = panel({"A": {0: 100, 1: 10, 2: 14, 3: 7, 4: 9}, "B": {0: 1, 2: 2, 3: 1, 4: 3}})
    reg = registry(split("A", 1, 10), dict(ticker="A", event_date=day(3), review_status="REJECTED", event_type=None),
                   dict(ticker="B", event_date=day(4), review_status="NOT_APPLICABLE", event_type="OTHER"),
                   # no candidate on this day: the decision must not reach the prices
                   dict(ticker="A", event_date=day(4), review_status="CONFIRMED", event_type="SPLIT", price_adjustment_factor=0.1))
    reviewed = D.apply_reviews(D.discontinuities(p), reg)
    a = A.adjusted_prices(p, reviewed)
    b = A.adjusted_from_registry(p, reg)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def failed(checks):
    return {r.check_name: r.violations for r in checks.filter("status = 'FAIL'").collect()}


def test_confirmed_decisions_must_take_effect(panel, registry):
    p = panel({"A": {0: 10, 1: 100, 2: 101}})
    A.require_covered(p, registry(split("A", 1, 0.1), dict(ticker="A", event_date=day(2), review_status="REJECTED", event_type=None)))
    with pytest.raises(Exception, match="without candidate: A 2024-01-03"):
        A.require_covered(p, registry(split("A", 2, 0.1)))
    with pytest.raises(Exception, match="without price row: B 2024-01-02"):
        A.require_covered(p, registry(split("B", 1, 0.1)))


def test_registry_rules(registry):
    good = split("A", 1, 10)
    assert failed(D.registry_checks(registry(good))) == {}
    assert failed(D.registry_checks(registry(good, good))) == {"KEY_UNIQUE": 1}
    assert failed(D.registry_checks(registry({**good, "quantity_multiplier": 10.2}))) == {"SPLIT_RECIPROCAL": 1}
    pay = confirmed("A", 1, "AMORTIZATION", cash_amount_per_unit=1.0, in_kind_amount_per_unit=0.0)
    assert failed(D.registry_checks(registry({**pay, "total_economic_value_per_unit": 1.0 + 1e-7}))) == {
        "AMORTIZATION_COMPONENT_SUM": 1}
    assert failed(D.registry_checks(registry({**pay, "total_economic_value_per_unit": 1.0 + 1e-9}))) == {}
    assert failed(D.registry_checks(registry({**good, "confirmation_source": " "}))) == {"CONFIRMED_SOURCE_PRESENT": 1}


def test_queue_order(panel, registry):
    p = panel({"A": {0: 10, 1: 20}, "B": {0: 10, 1: 21.5}, "C": {0: 10, 1: 16}, "D": {0: 10, 1: 13.5}, "E": {0: 10, 1: 28}})
    queue = D.review_queue(D.apply_reviews(D.discontinuities(p), registry()))
    assert [(r.ticker, r.review_priority) for r in queue.collect()] == [
        ("A", "P1"), ("B", "P2"), ("E", "P3"), ("C", "P3"), ("D", "P4")]


def test_windows_need_all_their_values(panel, registry):
    p = panel({"A": {n: 1.01 ** n for n in range(8)}})
    got = rows(H.price_history(A.adjusted_from_registry(p, registry()), [5]), "trade_date")
    assert [r["return_5d"] is None for r in got] == [True] * 5 + [False] * 3   # five returns need six prices
    assert [r["ma_5"] is None for r in got] == [True] * 4 + [False] * 4
    assert got[5]["return_5d"] == pytest.approx(1.01 ** 5 - 1)
    assert got[7]["volatility_5d"] == pytest.approx(0, abs=1e-12)
    assert failed(H.history_checks(H.price_history(A.adjusted_from_registry(p, registry())))) == {}


def test_factors_and_lookbacks_take_a_row_once(spark, panel, registry):
    from brickfolio.operators import adjusted as A, eligibility as EL, quality as Q

    closes = [90.0, 30.0, 31.0, 62.0, 61.0, 61.5, 20.5, 20.0]
    prices = panel({"A": dict(enumerate(closes)), "B": {0: 5.0, 1: 5.1}})
    thirds = {1: 1 / 3, 3: 2.0, 6: 1 / 3}
    decided = registry(*[dict(ticker="A", event_date=day(n), review_status="CONFIRMED", event_type="SPLIT", quantity_multiplier=1 / f,
                              price_adjustment_factor=f) for n, f in thirds.items()])
    rows = A.adjusted_from_registry(prices, decided)
    got = {(r.ticker, r.trade_date): r.structural_adjustment_factor for r in rows.collect()}
    for n in range(len(closes)):
        want = 1.0
        for at, f in thirds.items():
            want *= f if at > n else 1.0
        assert got["A", day(n)] == want
    assert got["B", day(0)] == got["B", day(1)] == 1.0
    signals = EL.temporal_signals(Q.price_quality(rows))
    for table in (rows, signals):
        plan = table._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "rowframe, 1, unboundedfollowing" not in plan and "rowframe, -20, currentrow" not in plan
