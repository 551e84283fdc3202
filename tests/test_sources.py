import json
import os
import random

import pytest
from pyspark.sql import functions as F

from waterline.config import LeagueConfig
from waterline.plans.valuation import value_projections
from waterline.sources import backfill, ingest, pages, sinks, storage, tables

PAGE = """
<html><table id="nav"><tbody><tr><td>no</td></tr></tbody></table>
<table class="t" id="data"><thead><tr><th>Player</th><th> YDS </th><th></th><th>YDS</th><th></th><th>YDS</th></tr></thead>
<tbody>
 <tr><td><a href="x">Josh <b>Allen</b></a> <span>(BUF)</span></td><td>1,234.5</td><td>a &amp; b</td><td>2</td><td>3</td><td>4</td><td>surplus</td></tr>
 <tr class="ad"></tr>
 <tr><td>Nobody</td><td>-</td></tr>
</tbody></table></html>
"""


def page_frame(spark):
    rows = [(1, PAGE), (2, "<table><tbody><tr><td>x</td></tr></tbody></table>"), (3, "no table")]
    return spark.createDataFrame(rows, "page int, html string")


def test_stat_table_cells(spark):
    rows = pages.table_rows(page_frame(spark), ["page"], "html").orderBy("row").collect()
    assert [r.page for r in rows] == [1, 1]
    assert rows[0].headers == ["Player", "YDS", "Column", "YDS_1", "Column_1", "YDS_2"]
    assert rows[0].cells == ["JoshAllen(BUF)", "1,234.5", "a & b", "2", "3", "4"]
    assert rows[1].cells == ["Nobody", "-"]
    cells = pages.table_cells(page_frame(spark), ["page"], "html").filter("row = 2").orderBy("col").collect()
    assert [(c.col, c.header, c.value) for c in cells] == [(0, "Player", "Nobody"), (1, "YDS", "-")]
    wide = pages.table_columns(page_frame(spark), ["page"], "html", ["Player", "YDS_2", "gone"]).orderBy("row").collect()
    assert [(w.Player, w.YDS_2, w.gone) for w in wide] == [("JoshAllen(BUF)", "4", None), ("Nobody", None, None)]


def test_header_rows(spark):
    df = spark.createDataFrame([(["A", "", "A", "B", "", "A"],)], "names array<string>")
    got = df.select(pages.unique_headers(F.col("names")).alias("n")).first().n
    assert got == ["A", "Column", "A_1", "B", "Column_1", "A_2"]


def test_real_markup(spark):
    html = (
        '<table data-id="data"><tbody><tr><td>no</td></tr></tbody></table>'
        "<table class='a>b' id=data><thead><tr><th>A</th><th>A_1</th><th>A</th></tr></thead><tbody>"
        '<tr title="x>y"><td data-x="y">">Ja&#x27;Marr &eacute;&#233;</td><td>&amp;lt; &lt;b&gt; &unknown; &#xD800;</td><td>a&nbsp;&#160;b</td></tr>'
        "</tbody></table>"
    ).replace('data-x="y">"', "data-x='y\">'")
    bad = "<table id='data'><thead><tr><th>A</th></tr></thead><tbody><tr><td title=\"open>x</td></tr></tbody></table>"
    df = spark.createDataFrame([(1, html), (2, bad), (3, None)], "page int, html string")
    cells = [c.value for c in pages.table_cells(df, ["page"], "html").filter("page = 1").orderBy("col").collect()]
    assert cells == ["Ja'Marr éé", "&lt; <b> &unknown; \ufffd", "a  b"]
    wide = pages.table_columns(df, ["page"], "html", ["A", "A_1"]).filter("page = 1").collect()
    assert [(w.A, w.A_1) for w in wide] == [(cells[0], cells[1])]


def test_missing_periods_read_number_texts(spark):
    loaded = spark.createDataFrame([("2020.0", "1", "qb"), ("x", None, "QB"), ("99999999999", "2", "QB")], "year string, week string, pos string")
    got = backfill.missing_periods(backfill.expected_periods(spark, 2020, 2020, 2, ["QB"]), loaded).collect()
    assert [(r.year, r.week) for r in got] == [(2020, 2)]


@pytest.mark.parametrize(
    "pos, headers, renamed",
    [
        ("qb", "ATT CMP YDS TDS INTS ATT_1 YDS_1 TDS_1 FL FPTS",
         "PassingATT PassingCMP PassingYDS PassingTD INTS RushingATT RushingYDS RushingTD FL -"),
        ("rb", "ATT YDS TD REC YDS_1 TD_1 FL", "RushingATT RushingYDS RushingTD REC ReceivingYDS ReceivingTD FL"),
        ("wr", "REC YDS TDS ATT YDS_1 TDS_1 G", "REC ReceivingYDS ReceivingTD RushingATT RushingYDS RushingTD -"),
        ("te", "REC YDS TD FL", "REC ReceivingYDS ReceivingTD FL"),
    ],
)
def test_renames(pos, headers, renamed):
    wanted = {h: r for h, r in zip(headers.split(), renamed.split()) if r != "-"}
    assert ingest.rename_map(pos, ["Player", "Team", *headers.split()]) == wanted


def test_current_projections(spark):
    qb = spark.createDataFrame([("Josh AllenBUFhighlow", "4,012.54100.13900.2", "25")], "Player string, YDS string, TDS string")
    te = spark.createDataFrame([("Taysom HillNOhighlow", "10.0", "x"), ("Travis KelceKChighlow", "90.5", "")], "Player string, REC string, OTHER string")
    got = {r.Player: r for r in ingest.current_projections({"QB": qb, "TE": te}, 2026).collect()}
    assert set(got) == {"Josh Allen", "Travis Kelce"}
    allen, kelce = got["Josh Allen"], got["Travis Kelce"]
    assert (allen.Year, allen.Team, allen.Pos) == (2026, "BUF", "QB")
    assert (allen.PassingYDS, allen["PassingYDS High"], allen["PassingYDS Low"]) == (4012.5, 4100.1, 3900.2)
    assert (allen.PassingTD, allen["PassingTD High"], allen.REC) == (25.0, None, None)
    assert (kelce.Team, kelce.REC, kelce.OTHER) == ("KC", 90.5, None)


def test_market_columns():
    assert ingest.market_columns(["Rank", "Player Team (Bye)", "POS", "AVG"]) == ("Player Team (Bye)", "Rank", "AVG")
    assert ingest.market_columns(["a", "b"]) == ("b", None, None)
    assert ingest.market_columns(["only"]) == ("only", None, None)


def test_market_table_without_numbers(spark):
    df = spark.createDataFrame([("1", "Josh Allen BUF (7)")], "id string, who string")
    assert tuple(ingest.market_table(df, 2026).first()) == (2026, "Josh Allen", "BUF", None, "", None)


def test_weekly_table(spark):
    df = spark.createDataFrame([("Josh Allen (BUF)", "1,250", "-", "x")], "Player string, YDS string, TD string, FL string")
    row = ingest.weekly_table(df, "qb", 2020, 3).first().asDict()
    assert row == {"Player": "Josh Allen", "Team": "BUF", "Pos": "QB", "Year": 2020, "Week": 3,
                   "PassingYDS": 1250.0, "PassingTD": None, "FL": None}


def test_missing_periods(spark):
    grid = backfill.expected_periods(spark, 2020, 2021, last_week=2, positions=("QB", "RB"))
    assert grid.count() == 8
    loaded = spark.createDataFrame([(2020.0, 1.0, "qb"), (2020.0, 1.0, "QB"), (2021.0, 2.0, "RB")], "year double, week double, pos string")
    left = {tuple(r) for r in backfill.missing_periods(grid, loaded).collect()}
    assert len(left) == 6 and (2020, 1, "QB") not in left and (2021, 2, "RB") not in left


def test_csv_round_trip_and_fallbacks(spark, tmp_path):
    source = spark.createDataFrame([('A "B", Jr.\nX', None, 1.5)], "Player string, Team string, AVG double")
    path, absent = str(tmp_path / "p"), str(tmp_path / "none")
    sinks.write_table_csv(source, path)
    back = tables.read_csv(spark, path)
    assert [tuple(r) for r in back.collect()] == [('A "B", Jr.\nX', None, "1.5")]
    both = tables.read_projection_inputs(spark, path, path, absent)
    assert not both.is_fallback and both.market.count() == 1
    fallback = tables.read_projection_inputs(spark, path, absent, path)
    assert fallback.is_fallback and fallback.market.count() == 0 and "ADP Rank" in fallback.market.columns
    assert tables.read_weekly_history(spark, absent).count() == 0


def test_manifest(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"updated_at": "2026-01-02T03:04:05+00:00", "season_year": 2026}, indent=2))
    row = tables.manifest_time(tables.read_json_document(spark, str(path))).first()
    assert (row.updated_at.isoformat(), row.season_year, row.current_adp) == ("2026-01-02T03:04:05", 2026, None)
    path.write_text(json.dumps({"updated_at": "yesterday"}))
    assert tables.manifest_time(tables.read_json_document(spark, str(path))).first().updated_at is None


def test_export(spark, tmp_path):
    rows = [(i, f'P"{i}', None, "QB", float(10 - i)) for i in range(6)]
    df = spark.createDataFrame(rows, "ord int, Player string, Team string, POS string, AVG double")
    results = value_projections(df, LeagueConfig(teams=1), "ord").results
    sinks.export_results(results, str(tmp_path / "e"))
    back = tables.read_csv(spark, str(tmp_path / "e"))
    assert back.columns == [header for header, _ in sinks.EXPORT_COLUMNS]
    got = back.orderBy(F.col("Overall Rank").cast("int")).collect()
    assert [r.Player for r in got] == [f'P"{i}' for i in range(6)]
    assert got[0].Team is None and got[0].ADP is None and got[0]["Pos Rank"] == "1QB"
    text = "".join(open(tmp_path / "e" / f).read() for f in sorted(os.listdir(tmp_path / "e")) if f.endswith(".csv"))
    assert '"P""0"' in text


def test_weekly_partitions_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "w")
    schema = "year int, week int, pos string, player string, fpts double"
    sinks.write_weekly(spark.createDataFrame([(2020, 1, "QB", f"a{i}", 1.0) for i in range(50)] + [(2020, 2, "QB", "b", 2.0)], schema), path)
    sinks.write_weekly(spark.createDataFrame([(2020, 2, "QB", "c", 3.0), (2020, 3, "QB", "d", 4.0)], schema), path)
    got = tables.read_weekly_table(spark, path)
    assert {r.player for r in got.filter("week > 1").collect()} == {"c", "d"} and got.filter("week = 1").count() == 50


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "key string, value string, updated_at timestamp_ntz"
    from datetime import datetime

    sinks.append_run_log(spark.createDataFrame([("a", "1", datetime(2026, 1, 1)), ("b", "1", datetime(2026, 1, 1))], schema), path)
    sinks.append_run_log(spark.createDataFrame([("a", "2", datetime(2026, 1, 2))], schema), path)
    got = {r.key: r.value for r in sinks.latest_run_values(spark.read.parquet(path)).collect()}
    assert got == {"a": "2", "b": "1"}


def test_checkpoint_folder_comes_from_the_session(spark):
    assert storage.shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert storage.scratch_path(spark, "x").startswith(storage.shared_dir(spark))
    cut = storage.materialise(spark.range(3))
    assert cut.inputFiles() and all(storage.shared_dir(spark) in f for f in cut.inputFiles())
    assert cut.count() == 3 and storage.materialise(spark.range(0)).count() == 0


def test_stages_are_dropped_by_scope(spark):
    from waterline.sources.storage import drop_stages, materialise, scratch_scope

    kept = materialise(spark.range(3))
    with scratch_scope("one"):
        gone = materialise(spark.range(4))
    drop_stages(spark, "one")
    assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|not found"):
        gone.count()


def test_repeated_headers_and_input_order(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    for k in range(3):
        lines = ["Player,YDS,TD,YDS,TD,"] + [f'"p{k}{i:03}",{i},1,{2 * i},2,x' for i in range(40)]
        (folder / f"part-{k}.csv").write_text("\n".join(lines))
    assert tables.header_names(["A", None, "A", "", "A"]) == ["A", "_c1", "A_1", "_c3", "A_2"]
    for multi_line in (True, False):
        got = tables.read_csv(spark, str(folder), multi_line, order="ord")
        assert got.columns == ["Player", "YDS", "TD", "YDS_1", "TD_1", "_c5", "ord"]
        rows = got.orderBy("ord").collect()
        assert [r.Player for r in rows] == [f"p{k}{i:03}" for k in range(3) for i in range(40)] and len({r.ord for r in rows}) == 120
        assert rows[5].YDS_1 == "10" and rows[5].TD_1 == "2"
    results = value_projections(
        tables.read_csv(spark, str(folder), order="ord").selectExpr("*", "'QB' AS Pos", "YDS AS AVG"), LeagueConfig(teams=1), "ord"
    ).results
    assert results.count() == 120


NESTED = """
<!-- <table id="data"><thead><tr><th>no</th></tr></thead><tbody><tr><td>x</td></tr></tbody></table> -->
<script>var t = "<table id='data'><tbody>";</script><STYLE>td > b { x: "</td>" }</style>
<table id="nav"><tr><td>n</td></tr></table>
<table title="<table id='data'>" id="data"><thead><tr><th>A</th><th>B<!-- th --></th><th>C</th></tr></thead><tbody>
<tr><td>1</td><td> x <!-- no --> y <table><thead><tr><th>q</th></tr></thead><tbody><tr><td> in </td></tr></tbody></table></td><td>3</td></tr>
<!-- <tr><td>gone</td></tr> -->
<tr><td>4<script>"</td>"</script></td><td title="a > b">5</td></tr></tbody></table>
<table id="data"><tbody><tr><td>second</td></tr></tbody></table>"""


def test_tables_inside_cells_comments_and_scripts(spark):
    pages_of = {
        1: NESTED, 2: "<table id=data><tbody></tbody></table>", 3: "<p>", 4: None, 5: "<table id=data><thead><tr><th>A</th></tr></thead></table>",
        6: "<table id='data'><thead><tr><th>A</th></tr></thead><tbody><tr><td>a</tr><tr><td>b", 7: NESTED.replace("<t", "<T").replace("</t", "</T"),
        8: "<table id=data><thead><tr><th>A</th><th>B</th></tr></thead><tbody>" + "<tr><td>o<table><tr><td>i</td></tr></table></td></tr>" * 200 + "</tbody></table>",
        9: "a\x01<table id=data></td></tr><thead></tr><tr><th>\x01A</th></tr></thead><tbody></td><tr></td><td>z</td></tr></tbody></table>",
    }
    df = spark.createDataFrame(list(pages_of.items()), "page int, html string")
    problems = {r.page: r.problem for r in pages.parsed_pages(df, ["page"], "html").collect()}
    assert problems == {1: None, 2: pages.NO_HEAD, 3: pages.NO_TABLE, 4: pages.NO_TABLE, 5: pages.NO_BODY, 6: None, 7: None, 8: None, 9: None}
    rows = pages.table_rows(df, ["page"], "html").orderBy("page", "row").collect()
    for page in (1, 7):
        assert [(r.row, r.cells) for r in rows if r.page == page] == [(0, ["1", "xyqin", "in"]), (2, ["in"]), (3, ["4", "5"])]
        assert next(r.headers for r in rows if r.page == page) == ["A", "B", "C"]
    assert [r.cells for r in rows if r.page == 6] == [["a"], ["b"]]
    assert [(r.row, r.cells) for r in rows if r.page == 8] == [(k, ["i"] if k % 2 else ["oi", "i"]) for k in range(400)]
    assert [(r.headers, r.cells) for r in rows if r.page == 9] == [(["A"], ["z"])]


def test_elements_equal_a_parse_by_a_stack(spark):
    """Random streams of start and end tags, against counting by hand."""
    import random

    def by_hand(tokens):
        depth, starts, spans = 0, [], {}
        for at, token in enumerate(tokens):
            if token == "<td>":
                starts.append(at)
                depth += 1
            elif token == "</td>" and starts:
                spans[starts.pop()] = at
        text = lambda a, b: "".join(t if t[0] != "<" else "" for t in tokens[a + 1 : b])
        return [text(a, spans.get(a, len(tokens))) for a, t in enumerate(tokens) if t == "<td>"]

    rng = random.Random(2)
    streams = [[rng.choice(["<td>", "</td>", "x", "y"]) for _ in range(rng.randint(0, 30))] for _ in range(300)]
    df = spark.createDataFrame([(k, "".join(s)) for k, s in enumerate(streams)], "k int, html string")
    got = {r.k: r.c for r in df.select("k", pages._cells(pages.tag_stream(F.col("html")), "td").alias("c")).collect()}
    assert all(got[k] == by_hand(s) for k, s in enumerate(streams))


def weekly_page(rows, head=("Player", "YDS", "FL"), table="data"):
    cells = lambda tag, row: "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in row) + "</tr>"
    return f"<table id={table}><thead>{cells('th', head)}</thead><tbody>{''.join(cells('td', r) for r in rows)}</tbody></table>"


def test_backfill_keeps_bad_pages_aside_and_loads_a_period_after_its_rows(spark, tmp_path, monkeypatch):
    store = backfill.WeeklyStore(str(tmp_path / "weekly"))
    grid = backfill.expected_periods(spark, 2020, 2020, last_week=3, positions=("QB", "WR"))
    page = lambda week, pos, html: (2020, week, pos, "http://x", html)
    good = [page(1, "qb", weekly_page([("A B (KC)", "1,200", 1), ("C D (NE)", "-", 2)])), page(1, "WR", weekly_page([("E F (SF)", 7, 0)]))]
    bad = [page(2, "qb", weekly_page([("G H (KC)", 3, 0)])), page(2, "qb", weekly_page([("I J (KC)", 4, 0)], table="other"))]
    odd = [page(3, "WR", weekly_page([("K", 1)])), page(3, "QB", weekly_page([])), page(2, "WR", weekly_page([("x", 1, 2)], head=("Who", "YDS", "FL")))]
    frame = lambda rows: spark.createDataFrame(rows, "year int, week int, pos string, url string, page string")

    backfill.backfill_from_pages(frame([*good, *bad, *odd]), store, grid, "a", html="page")
    got = {(r.week, r.pos, r.Player): r for r in store.weekly(spark).collect()}
    assert set(got) == {(1, "QB", "A B"), (1, "QB", "C D"), (1, "WR", "E F")}
    first = got[1, "QB", "A B"]
    assert (first.Team, first.PassingYDS, first.FL, first.ReceivingYDS) == ("KC", 1200.0, 1.0, None) and got[1, "WR", "E F"].ReceivingYDS == 7.0
    assert set(store.weekly(spark).columns) == {"year", "week", "pos", "Player", "Team", "PassingYDS", "ReceivingYDS", "FL"}
    aside = sorted((r.week, r.pos, r.problem) for r in store.quarantine(spark).collect())
    assert aside == [(2, "QB", pages.NO_TABLE), (2, "WR", backfill.NO_PLAYER), (3, "WR", backfill.SHORT_ROWS)]

    # A run that ends after its rows are written has loaded nothing; the next one replaces them.
    mended = frame([*good, bad[0], page(2, "qb", weekly_page([("I J (KC)", 4, 0)], head=("Player", "YDS", "G")))])
    real = backfill.write_weekly
    monkeypatch.setattr(backfill, "write_weekly", lambda rows, path: (real(rows, path), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        backfill.backfill_from_pages(mended, store, grid, "b", html="page")
    monkeypatch.setattr(backfill, "write_weekly", real)
    assert store.weekly(spark).count() == 3 and spark.read.parquet(store.rows).count() == 5
    backfill.backfill_from_pages(mended, store, grid, "c", html="page")
    rows = {(r.Player, r.PassingYDS, r.G) for r in store.weekly(spark).filter("week = 2").collect()}
    assert rows == {("G H", 3.0, None), ("I J", 4.0, 0.0)}
    assert sorted((r.week, r.pos, r.rows, r.run) for r in store.loads(spark).collect()) == [(1, "QB", 2, "a"), (1, "WR", 1, "a"), (2, "QB", 2, "c")]
    # Nothing is left to do for what is loaded.
    backfill.backfill_from_pages(mended, store, grid, "d", html="page")
    assert store.loads(spark).filter("run = 'd'").count() == 0 and store.weekly(spark).count() == 5


def test_keys_of_a_page_are_no_stats(spark):
    df = spark.createDataFrame([(7, 0, "Josh Allen (BUF)", "1,250", "3")], "page int, row int, Player string, YDS string, REC string")
    weekly = ingest.weekly_table(df, "qb", 2020, 3, keys=("page", "row")).first().asDict()
    assert weekly == {"Player": "Josh Allen", "Team": "BUF", "Pos": "QB", "Year": 2020, "Week": 3, "page": 7, "row": 0, "PassingYDS": 1250.0, "REC": 3.0}
    found = ingest.current_projections({"QB": df}, 2026, keys=("page", "row"))
    assert found.columns[:6] == ["Year", "Player", "Team", "Pos", "page", "row"] and "page High" not in found.columns


def test_layouts_come_from_pages_that_are_parsed(spark, monkeypatch):
    html = "<table id=data><thead><tr><th>a</th><th>b</th></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>"
    asked, real = [], pages.layouts
    monkeypatch.setattr(pages, "layouts", lambda rows, by=(): asked.append(rows) or real(rows, by))
    df = spark.createDataFrame([(1, html), (2, html.replace("<th>b", "<th>c")), (3, "none")], "k int, html string")
    got = pages.stat_frame(df, ["k"], "html")
    assert [tuple(r) for r in got.orderBy("k").collect()] == [(1, 0, "1", "2", None), (2, 0, "1", None, "2")]
    plan = asked[0].filter("size(headers) > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower()


def test_layouts_are_few(spark, monkeypatch):
    df = spark.createDataFrame([(k, weekly_page([("a", 1, 2)], head=("Player", f"h{k}", "FL"))) for k in range(4)], "k int, html string")
    assert pages.stat_frame(df, ["k"], "html").columns == ["k", "row", "Player", "h0", "FL", "h1", "h2", "h3"]
    monkeypatch.setattr(pages, "MOST_LAYOUTS", 3)
    with pytest.raises(ValueError):
        pages.stat_frame(df, ["k"], "html")


def test_damaged_manifests_have_no_entries(spark, tmp_path):
    documents = {
        "a.json": '{"updated_at": "2024-01-02T00:00:00Z",\n "k": "one", "n": 3, "deep": {"x": [1]}, "none": null}', "b.json": '{"updated_at": "2025-01-01T00:00:00Z", "k": "tw',
        "c.json": "", "d.json": "[1, 2]", "e.json": '{"updated_at": "never", "late": true}',
    }
    for name, text in documents.items():
        (tmp_path / name).write_text(text)
    found = tables.manifest_entries(spark, str(tmp_path))
    assert {(r.key, r.value) for r in found.collect()} == {("k", "one"), ("n", "3"), ("deep", '{"x":[1]}'), ("late", "true")}
    assert found.filter("updated_at IS NULL").count() == 0


def test_a_compacted_log_says_the_same(spark, tmp_path):
    rows = [(f"k{k % 5}", f"v{k}", f"2024-01-{1 + k % 20:02d}") for k in range(60)]
    log = spark.createDataFrame(rows, "key string, value string, t string").selectExpr("key", "value", "cast(t AS timestamp_ntz) AS updated_at")
    sinks.append_run_log(log, str(tmp_path / "log"))
    sinks.compact_run_log(spark, str(tmp_path / "log"), str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    key = lambda df: sorted(map(tuple, df.select("key", "value", "updated_at").collect()))
    assert small.count() == 5 and key(sinks.latest_run_values(small)) == key(sinks.latest_run_values(log, tie_break="value")) == key(small)
    sinks.append_run_log(log.limit(1).selectExpr("'k0' AS key", "'new' AS value", "timestamp_ntz'2030-01-01' AS updated_at"), str(tmp_path / "small"))
    assert sinks.latest_run_values(spark.read.parquet(str(tmp_path / "small"))).filter("key = 'k0'").first().value == "new"


def test_nested_elements_need_no_counting(spark, monkeypatch):
    inner = "<table id=in><tbody><tr><td>x</td></tr></tbody></table>"
    page = f"<table id='data'><tbody><tr><td>a{inner}</td><td>b</td></tr><tr></tr></tbody></table>"
    rows = spark.createDataFrame([(page,)], "html string").select(pages.tag_stream(F.col("html")).alias("s"))
    found = lambda: rows.select(pages.first_element(F.col("s"), "table", pages.DATA_TABLE), pages.elements(F.col("s"), "tr"), pages.elements(F.col("s"), "td")).first()
    want = [found()[0], *map(list, found()[1:])]
    assert [len(x) for x in want[1:]] == [3, 3] and want[0].count("tbody") == 4
    monkeypatch.setattr(pages, "_pieces", lambda stream, name: F.array(F.raise_error(F.concat(stream, F.lit("counted"))).cast("string")))
    assert [found()[0], *map(list, found()[1:])] == want


def test_pattern_and_counting_find_the_same_elements(spark, monkeypatch):
    rng = random.Random(5)
    parts = ["<td>", "</td>", "<TD class='>'>", "</tr>", "<tr>", "x", " ", "<b>", "<!-- <td> -->", '<td a="', "</td", "<td/>"]
    texts = ["".join(rng.choices(parts, weights=[6, 8, 2, 1, 2, 4, 2, 1, 1, 0.2, 0.2, 0.5], k=rng.randint(0, 30))) for _ in range(600)]
    texts += [None, "<td>" * 9 + "x" + "</td>" * 9, "<td>" * 4 + "</td>" * 5]
    rows = spark.createDataFrame([(t,) for t in texts], "html string").repartition(4).select("html", pages.tag_stream(F.col("html")).alias("s"))
    found = lambda: {r[0]: r[1:] for r in rows.select("html", pages.elements(F.col("s"), "td"), pages.first_element(F.col("s"), "td")).collect()}
    by_pattern = found()
    monkeypatch.setattr(pages, "_balanced", lambda name: "(?!)")
    assert by_pattern == found() and len(by_pattern) > 500
