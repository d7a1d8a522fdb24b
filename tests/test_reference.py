"""Reference datasets: fields beyond the schema or unfit, broken pages, repeated records, listing and pushed filters."""

import datetime

import pytest

from barlight.sources import reference as R


def ingest(spark, dataset, *texts):
    return R.ingest(spark.createDataFrame(list(enumerate(texts)), "page int, value string"), dataset)


def test_fields_beyond_and_unfit_are_rescued(spark):
    rows = ingest(spark, "splits", '{"results":[{"ticker":"A","execution_date":"2024-01-02","split_from":1,"split_to":"two","id":"x","new":{"a":[1]}},{"ticker":"B"}],"next_url":"u"}', '{"results":[]}', '{"status":"OK"}', "oops{", None).orderBy("ticker").collect()
    assert [r.ticker for r in rows] == ["A", "B"]
    assert (rows[0].execution_date, rows[0].split_from, rows[0].split_to) == (datetime.date(2024, 1, 2), 1.0, None)
    assert rows[0].rescued == {"split_to": "two", "new": '{"a":[1]}'} and rows[1].rescued is None


def test_nested_and_array_pages(spark):
    c = ingest(spark, "conditions", '{"results":[{"id":7,"asset_class":"stocks","sip_mapping":{"CTA":"A","UTP":"@"},"update_rules":{"consolidated":{"updates_high_low":true}},"data_types":["trade","quote"]}]}').first()
    assert c.sip_mapping.UTP == "@" and c.sip_mapping.OPRA is None and c.update_rules.consolidated.updates_high_low is True and c.update_rules.market_center is None and c.data_types == ["trade", "quote"]
    h = ingest(spark, "holidays", '[{"date":"2024-11-28","exchange":"NYSE","name":"Thanksgiving","status":"closed"},{"date":"2024-11-29","exchange":"NYSE","open":"2024-11-29T14:30:00.000Z","status":"early-close"}]').orderBy("date").collect()
    assert [r.status for r in h] == ["closed", "early-close"] and h[1].open.hour in (14, 9, 15) and h[0].rescued is None


def test_broken_pages(spark):
    pages = spark.createDataFrame([('{"results":[]}',), ("[]",), ('{"x":1}',), ("{",), (None,)], "value string")
    assert sorted(str(r.value) for r in R.broken_pages(pages).collect()) == ["None", "{", '{"x":1}']


def test_the_last_record_of_a_key_counts(spark):
    rows = ingest(spark, "exchanges", '{"results":[{"id":1,"name":"old"},{"id":2,"name":"b"},{"name":"no key"}]}', '{"results":[{"id":1,"name":"new","extra":1}]}')
    last = {r.id: r for r in R.latest_records(rows, "exchanges", "page").collect()}
    assert set(last) == {1, 2} and last[1].name == "new" and last[1].rescued == {"extra": "1"}


def test_listing(spark, tmp_path):
    records = ",".join('{"ticker":"T%02d","market":"stocks","name":"Name %d Corp","active":%s,"type":"CS"}' % (k, k % 5, "true" if k % 2 else "false") for k in range(40))
    path = str(tmp_path)
    R.write_dataset(ingest(spark, "tickers", '{"results":[%s]}' % records).drop("page"), path, "tickers")
    names = lambda **k: [r.ticker for r in R.query(spark, path, "tickers", **k).collect()]
    assert names(limit=3) == ["T00", "T01", "T02"]
    assert names(sort="name", order="desc", limit=2) == ["T04", "T09"]
    assert names(ticker__gte="T05", ticker__lt="T09", active=True, sort="ticker") == ["T05", "T07"]
    assert names(search="NAME 3 corp", ticker__any_of=["T03", "T04", "T08"], sort="ticker", order="desc") == ["T08", "T03"]
    assert len(names()) == 40
    for wrong in ({"colour": 1}, {"sort": "colour"}, {"order": "up"}):
        with pytest.raises(ValueError):
            R.query(spark, path, "tickers", **wrong)
    plan = R.query(spark, path, "tickers", ticker="T05", active=True).select("name")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ticker,T05)" in plan and "EqualTo(active,true)" in plan and "composite_figi" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("dataset", R.DATASETS)
def test_every_dataset_has_its_key(spark, dataset):
    assert set(R.key_of(dataset)) <= set(R.schema_of(dataset).names)
    assert ingest(spark, dataset, '{"results":[{}]}').count() == 1


def test_universe_lists_by_year_and_name(spark, tmp_path):
    rows = spark.createDataFrame([(2023, "big", "B", 2.0), (2023, "big", "A", 1.0), (2024, "all", "C", None)], "year int, name string, ticker string, market_cap double")
    R.write_universe(rows, str(tmp_path / "u"))
    back = R.read_universe(spark, str(tmp_path / "u"), "ticker string, market_cap double, year int, name string")
    assert [(r.ticker, r.market_cap) for r in back.where("year = 2023 and name = 'big'").collect()] == [("A", 1.0), ("B", 2.0)]
    assert (tmp_path / "u" / "year=2024" / "name=all").is_dir()
