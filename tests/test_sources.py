"""The catalogue and the normalizers on small synthetic payloads."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from brightwater.sources import catalog, normalize

NOW = dt.datetime(2024, 5, 1)


def raw(spark, *payloads):
    return spark.createDataFrame([(" abc ", NOW, None if p is None else json.dumps(p)) for p in payloads], "symbol string, fetched_at timestamp, payload string")


def test_declarations():
    assert len(catalog.EXPOSURES) == 58 and catalog.bars_table("1d") == "price_history"
    assert catalog.EXPOSURES["mutualfund_holders"].fixed == (("holder_type", "mutualfund"),)
    for bad in (lambda: catalog.bars_table("2m"), lambda: catalog.page_size(0), lambda: catalog.page_size(5000),
                lambda: catalog.window("intraday", dt.date(2024, 1, 1), dt.date(2024, 3, 1), NOW.date()), lambda: catalog.window("daily", dt.date(2024, 2, 1), dt.date(2024, 1, 1), NOW.date())):
        with pytest.raises(ValueError):
            bad()
    assert catalog.window("intraday", None, None, dt.date(2024, 1, 31)) == (dt.date(2024, 1, 1), dt.date(2024, 2, 1))


def test_read_pages(spark):
    df = spark.createDataFrame([("ABC", dt.date(2024, 1, i % 5 + 1), f"H{i:02}", "institution" if i % 2 else "mutualfund", "{}") for i in range(30)], "symbol string, as_of_date date, holder string, holder_type string, raw_json string")
    e = catalog.EXPOSURES["institutional_holders"]
    seen, after = [], None
    while True:
        got = catalog.read(e, df, "abc", size=4, after=after).collect()
        seen += [r.holder for r in got[:4]]
        if len(got) <= 4:
            break
        after = [got[3].as_of_date, got[3].holder]
    want = sorted((r for r in df.collect() if r.holder_type == "institution"), key=lambda r: (r.as_of_date, r.holder), reverse=True)
    assert seen == [r.holder for r in want] and "raw_json" not in catalog.read(e, df, "abc").columns
    for bad in ({"symbol": None}, {"symbol": "ABC", "filters": {"holder": "x"}}):
        with pytest.raises(ValueError):
            catalog.read(e, df, **bad)


def test_frames(spark):
    rows = [{"index": "0q", "avg": 1.1, "numberOfAnalysts": 3.0, "low": "N/A"}, {"index": "0q", "avg": 1.2, "high": float("inf")}, {"avg": 9.0}]
    got = normalize.normalize("earnings_estimate", raw(spark, rows, [], None))["earnings_estimate"].collect()
    assert [(r.symbol, r.period, r.avg, r.number_of_analysts, r.high) for r in got] == [("ABC", "0q", Decimal("1.2"), None, None)]
    bars = [{"index": "2024-01-02 00:00:00-05:00", "Close": 5.0, "Volume": 7}, {"index": "2024-01-03 00:00:00-05:00", "Close": None}]
    (bar,) = normalize.normalize("bars", raw(spark, bars))["bars"].collect()
    assert (bar.close, bar.volume) == (Decimal(5), 7) and bar.open is None


def test_series_statement_map_labels(spark):
    got = normalize.normalize("dividends", raw(spark, [{"index": "2024-01-02 09:30:00-05:00", "value": 0.5}, {"index": "2024-01-02 10:00:00-05:00", "value": 0.6}, {"index": "2024-02-02", "value": 0.0}]))["dividends"].collect()
    assert [(r.day, r.amount) for r in got] == [(dt.date(2024, 1, 2), Decimal("0.6"))]
    out = normalize.normalize("valuation_measures", raw(spark, [{"index": "PE", "3/31/2024": 2.5, "Current": 3.0, "12/31/2023": None}, {"index": "PB", "3/31/2024": 1.0}]))
    assert [(r.period_end, r.item_count) for r in out["financial_periods"].collect()] == [(dt.date(2024, 3, 31), 2)]
    assert sorted((r.item_key, float(r.value)) for r in out["financial_facts"].collect()) == [("PB", 1.0), ("PE", 2.5)]
    (one,) = normalize.normalize("analyst_price_targets", raw(spark, {"low": 0.0, "high": 9, "surprise": 1}))["analyst_price_targets"].collect()
    assert (one.low, one.high, one.mean, one.unmapped, len(one.payload_hash)) == (Decimal(0), Decimal(9), None, ["surprise"], 64)
    (one,) = normalize.normalize("major_holders", raw(spark, [{"index": "institutionsCount", "Value": 139.0}]))["major_holders"].collect()
    assert one.institutions_count == Decimal(139) and one.insiders_percent_held is None
    with pytest.raises(ValueError):
        normalize.normalize("nothing", raw(spark))


def test_a_user_adds_a_kind_and_a_dataset(spark):
    from pyspark.sql import functions as F

    from brightwater.sources import normalize as n

    try:
        n.add_kind("percent", lambda t: t.try_cast("double") / 100)
        n.add_frame("own_ratings", "who", [n.Field("name", "who", "text16"), n.Field("share", "share", "percent"), n.Field("votes", "votes", "unsigned")])
        raw = spark.createDataFrame([("aapl", '[{"name":"a very long name of a rater","share":"12.5","votes":-1},{"name":"b","share":null,"votes":3},{"share":1}]')], "symbol string, payload string").withColumn("fetched_at", F.current_timestamp())
        got = sorted((r.symbol, r.who, r.share, r.votes) for r in n.normalize("own_ratings", raw)["own_ratings"].collect())
        assert got == [("AAPL", "a very long name", 0.125, None), ("AAPL", "b", None, 3)]
        for wrong in (lambda: n.add_kind("percent", lambda t: t), lambda: n.add_frame("own_ratings", "who", []), lambda: n.add_frame("x", "who", [n.Field("a", "b", "text")]), lambda: n.add_frame("x", "b", [n.Field("a", "b", "odd")])):
            with pytest.raises(ValueError):
                wrong()
    finally:
        n.CONVERT.pop("percent", None), n.FRAMES.pop("own_ratings", None)


def test_searches_and_their_parts(spark):
    from brightwater.sources import discovery as d

    at = dt.datetime(2024, 5, 1)
    body = {"quotes": [{"symbol": " aapl "}, {"name": "private"}, {"symbol": "B" * 40, "shortname": "long"}, {"symbol": "aapl", "shortname": "again"}, {"symbol": "MSFT", "shortname": "M", "score": 2.5}],
            "lists": [{"slug": "a", "name": "A"}, {"canonicalName": "a", "title": "T"}, {"canonicalName": "b", "title": "T", "total": 7}, {"name": "no key"}, {"slug": "x" * 200}],
            "researchReports": [{"id": "r", "reportDate": 1700000000000}, {"id": "r"}, {"id": "y" * 80}], "news": [{"uuid": "n", "title": "t", "providerPublishTime": 1700000000, "relatedTickers": ["X", "X", "Z" * 40]}, {"uuid": "m", "title": "t"}]}
    raw = spark.createDataFrame([("term", at, json.dumps(body)), ("none", at, "{}"), ("odd", at, "broken"), ("null", at, None)], "query_term string, fetched_at timestamp, payload string")
    got = d.search(raw)
    assert sorted((r.symbol, r.rank_index, r.is_known, r.short_name) for r in got["search_quotes"].collect()) == [("B" * 40, 1, False, "long"), ("MSFT", 2, True, "M"), ("aapl", 0, True, None)]
    assert sorted((r.list_key, r.rank_index, r.name, r.total) for r in got["search_lists"].collect()) == [("a", 0, "A", None), ("b", 1, "T", 7)]
    assert [(r.report_id, r.rank_index) for r in got["search_report_hits"].collect()] == [("r", 0)] and got["research_reports"].first().report_ts_utc is not None
    assert [(r.news_id, r.symbol) for r in got["news_symbols"].collect()] == [("n", "X")] and [r.news_id for r in got["news"].collect()] == ["n"]
    assert sorted(r.symbol for r in got["symbols"].collect()) == ["MSFT", "aapl"]

    found = d.lookup(spark.createDataFrame([("t", at, json.dumps({"documents": [{"symbol": "A", "lookupType": "all"}, {"x": 1}, {"symbol": "A", "lookupType": "equity"}, {"symbol": "B", "lookupType": "equity"}], "lookupTotals": {"all": 3, "privateCompany": 0, "odd": "x"}}))], raw.schema))
    assert sorted((r.symbol, r.rank_index, r.lookup_type) for r in found["lookup_results"].collect()) == [("A", 0, "all"), ("B", 3, "equity")]
    assert sorted((r.lookup_type, r.total) for r in found["lookup_totals"].collect()) == [("all", 3), ("privateCompany", 0)]

    boards = lambda text: d.market_summary(spark.createDataFrame([("US", at, text)], "region string, fetched_at timestamp, payload string"), spark.createDataFrame([("ES=F",)], "symbol string"))
    assert [(r.board_code, r.symbol, r.is_known) for r in boards('{"CME": {"symbol": "es=f", "regularMarketPrice": 1.5}}').collect()] == [("CME", "ES=F", True)]
    for wrong in ('{"error": "text"}', '{"%s": {}}' % ("c" * 17)):
        with pytest.raises(Exception, match="unexpected shape"):
            boards(wrong).collect()


def test_parts_of_payloads(spark):
    from brightwater.sources import nested as n

    raw = lambda *bodies: spark.createDataFrame([(" aapl ", NOW, b) for b in bodies], "symbol string, fetched_at timestamp, payload string")
    people = n.officers(raw('{"companyOfficers":[{"name":"Mr.  A  B","age":50},{"name":"Mr. A B","age":51},{"name":" ","age":1},{"age":2},{"name":"C","totalPay":"N/A"}]}', "{}", None))
    assert sorted((r.symbol, r.name, r.age, r.total_pay) for r in people.collect()) == [("AAPL", "C", None, None), ("AAPL", "Mr. A B", 50, None)]
    dates = [(r.earnings_date_start, r.earnings_date_end, r.earnings_date_count) for r in n.ticker_calendar(raw('{"Earnings Date":["2024-05-02","x","2024-05-06"]}', '{"Earnings Date":"2024-05-03"}', "{}")).collect()]
    assert sorted(dates, key=repr) == sorted([(dt.date(2024, 5, 2), dt.date(2024, 5, 6), 3), (dt.date(2024, 5, 3), dt.date(2024, 5, 3), 1), (None, None, 0)], key=repr)
    body = json.dumps([{"date": "2024-01-02", "epochDate": 1704153600, "type": "10-K", "title": "a", "edgarUrl": "https://x/0000320193-24-000001/", "exhibits": {"EX-1": "u", "EX-2": None}},
                       {"date": "2024-01-02", "epochDate": 1704153600, "type": "8-K", "edgarUrl": "https://x/0000320193-24-000001/", "exhibits": {"EX-1": "v"}}, {"date": "2024-01-02", "type": "8-K", "exhibits": {"EX-9": "lost"}}, {"date": "2024-01-03", "epochDate": 5, "type": "4"}])
    got = n.filings(raw(body))
    assert sorted((r.filing_id[:10], r.filing_type, r.exhibit_count) for r in got["sec_filings"].collect())[0] == ("0000320193", "8-K", 1) and got["sec_filings"].count() == 2
    assert sorted((r.exhibit_type, r.url) for r in got["sec_filing_exhibits"].collect()) == [("EX-1", "u"), ("EX-1", "v")]
    weights = n.fund_weightings(raw('{"sector_weightings":{"Real Estate":0.5,"x":null},"bond_ratings":{"bb":0.25}}', '{"bond_ratings":{}}'))
    assert sorted((r.category, r.item_key, float(r.weight)) for r in weights.collect()) == [("bond_rating", "bb", 0.25), ("sector", "real_estate", 0.5)]
    metrics = n.fund_metrics(raw('{"equity_holdings":[{"label":"Price/Book","own":"1.5","category":"2"}],"bond_holdings":[{"label":"Price/Book","own":"N/A"},{"own":"1"}]}'))
    assert sorted((r.section, r.metric, r.value and float(r.value)) for r in metrics.collect()) == [("bond", "price/book", None), ("equity", "price/book", 1.5)]
    assert [r.expiry_date for r in n.option_expirations(raw('{"expirations":["2024-06-21","2024-06-21","soon"]}', '{"expirations":[]}')).collect()] == [dt.date(2024, 6, 21)]


def test_screens_of_several_pages(spark):
    from brightwater.sources import screens as s

    page = lambda *symbols, total=9: json.dumps({"quotes": [{"symbol": x, "regularMarketPrice": i + 1} if x else {"shortName": "none"} for i, x in enumerate(symbols)], "total": total})
    late = NOW + dt.timedelta(hours=1)
    raw = [("a", NOW, 0, page("X", None, "Y")), ("a", NOW, 1, page("Z", "X", total=8)), ("a", NOW, 2, page()), ("b", late, 0, page("Z" * 40, "Y")), ("c", NOW, 0, "broken"), ("d", NOW, 0, None)]
    got = s.screens(spark.createDataFrame(raw, "screen_key string, fetched_at timestamp, page int, payload string"))
    assert sorted((r.screen_key, r.symbol[:2], r.rank_index, r.is_known) for r in got["screen_members"].collect()) == [("a", "X", 4, True), ("a", "Y", 2, True), ("a", "Z", 3, True), ("b", "Y", 1, True), ("b", "ZZ", 0, False)]
    assert sorted((r.symbol[:2], float(r.regular_market_price), r.fetched_at == late) for r in got["screen_quotes"].collect()) == [("X", 1.0, False), ("Y", 2.0, True), ("Z", 1.0, False), ("ZZ", 1.0, True)]
    assert sorted((r.screen_key, r.total, r.page_count, r.members) for r in got["screen_runs"].collect()) == [("a", 9, 3, 3), ("b", 9, 1, 2), ("c", None, 1, 0), ("d", None, 1, 0)]
    assert sorted(r.symbol for r in got["symbols"].collect()) == ["X", "Y", "Z"]


def test_sectors_and_industries(spark):
    from brightwater.sources import screens as s

    body = lambda symbol, *parts: json.dumps({"symbol": symbol, "name": "N", "industries": [{"key": k, "symbol": f"^{k}", "name": n} for k, n in parts]})
    raw = [("tech", NOW, body("^T", ("chips", "Chips"), (None, "All"), ("odd", None))), ("energy", NOW, body("^E", ("chips", "Other"), ("oil", "Oil"))), ("lost", NOW, body(None, ("gone", "Gone"))), ("null", NOW, None)]
    got = s.taxonomy(spark.createDataFrame(raw, "sector_key string, fetched_at timestamp, payload string"))
    assert sorted((r.domain_key, r.domain_type, r.parent_key, r.name) for r in got["domains"].collect()) == [("chips", "industry", "energy", "Other"), ("energy", "sector", None, "N"), ("oil", "industry", "energy", "Oil"), ("tech", "sector", None, "N")]
    assert sorted((r.symbol, r.is_active) for r in got["symbols"].collect()) == [("^E", False), ("^T", False), ("^chips", False), ("^oil", False)]
