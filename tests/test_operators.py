"""Cases that the tables do not show: order, ties, blanks, conflicts, files and streams."""

import json
import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from catloom.functions import records, text, urls, years
from catloom.operators import contracts, extract, filters, findings, incremental, match, order, relate, shape, stats, updates
from catloom.plans import extract_queries, relation_queries
from catloom.sources import readers, writers
from catloom.streaming import upserts


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "key"),
    [("½ Dólar", "1 2 dollar"), ("2½ cts", "2 1 2 cent"), ("10.000 réis", "10.000 reis"), ("5 øre", "5 ore"), ("", ""), (None, "")],
)
def test_normal_key(spark, name, key):
    assert one(spark, text.normalize_key(F.lit(name).cast("string"))) == key


@pytest.mark.parametrize(("name", "variants"), [("½ x", [["1", "2"]]), ("2½ x", [["2", "5"], ["2", "1", "2"]]), ("1.000", [["1000"], ["1.000"], ["1", "000"]]), ("5 x", [["5"]]), ("x", []), ("2 ¾", [["2", "75"], ["2", "3", "4"]]), ("1.000,5 x", [["10005"], ["1.000,5"], ["1", "000", "5"]]), ("5.", [["5"], ["5."]])])
def test_amount_variants(spark, name, variants):
    assert one(spark, text.amount_variants(F.lit(name))) == variants


@pytest.mark.parametrize(("value", "first", "last"), [("1957 - 61", 1957, 1957), ("from 1957-1961", 1957, 1961), ("none", None, None)])
def test_parse_years(spark, value, first, last):
    x = one(spark, years.parse_years(F.lit(value)))
    assert (x["first"], x["last"]) == (first, last)


def test_urls(spark):
    assert one(spark, urls.canonical_page_url(F.lit("HTTP://A.example.com/catalog/?b=2&page=1&a=1"))) == "http://a.example.com/catalog?a=1&b=2"
    assert one(spark, urls.detail_stem(F.lit("https://x.example.com/login?ref=%2Fcoin%2Fland-1-cent-1957%2F%3Ftid%3D1"))) == "land-1-cent-1957"
    assert one(spark, urls.is_http_url(F.lit("not a url"))) is False
    assert one(spark, urls.strip_trailing_years(F.lit("cent-1957-1961"))) == "cent"


def test_parse_amount_unit(spark):
    x = one(spark, text.parse_amount_unit(F.lit("2,5 rupees, 1957-61")))
    assert (x["name"], x["value"], x["unit"], x["period"]) == ("2,5 rupees", 2.5, "rupees", "1957-61")


def test_udfs(spark):
    rows = spark.createDataFrame([("abc", "abd"), (None, "x")], "a string, b string")
    got = rows.select(records.difflib_ratio("a", "b").alias("r"), records.nfkd_fold("a").alias("f")).collect()
    assert round(got[0]["r"], 4) == 0.6667 and got[1]["r"] == 0 and got[1]["f"] is None


def test_merge_is_an_ordered_fold(spark):
    rows = spark.createDataFrame([("k", 1, "a", ""), ("k", 2, "b", "c"), ("k", 3, "d", "e"), ("m", 1, None, None)], "k string, pos int, x string, y string")
    got = {r["k"]: (r["x"], r["y"], r["rows"]) for r in shape.dedup_merge(rows, ["k"], "pos", ["x", "y"]).collect()}
    assert got["k"] == ("b", "c", 3) and got["m"] == (None, None, 1)


def test_merge_fills_structs_and_keeps_to_its_guard(spark):
    rows = spark.createDataFrame([("k", 1, 7, ("a", None), None), ("k", 2, 8, ("x", "y"), "z"), ("k", 3, 7, (None, "c"), "d")], "k string, pos int, id int, s struct<p:string,q:string>, t string")
    got = shape.dedup_merge(rows, ["k"], "pos", ["id", "s", "t"], guard="id").first()
    assert (got["id"], tuple(got["s"]), got["t"]) == (7, ("a", "c"), "d")


@pytest.mark.parametrize("parts", [1, 17])
def test_partitions_do_not_matter(spark, parts):
    rows = spark.range(200).select(F.col("id").alias("pos"), (F.col("id") % 2).alias("part"), F.when(F.col("id") % 3 == 0, " ").otherwise((F.col("id") % 7).cast("string")).alias("key")).repartition(parts)
    got = [(r["pos"], r["rank"]) for r in order.gapless_rank(rows, ["part"], "key", "pos").orderBy("pos").collect()]
    want, seen = [], {0: {}, 1: {}}
    counts = {0: 0, 1: 0}
    for i in range(200):
        p, k = i % 2, "" if i % 3 == 0 else str(i % 7)
        if k and k in seen[p]:
            want.append((i, seen[p][k]))
            continue
        counts[p] += 1
        want.append((i, counts[p]))
        if k:
            seen[p][k] = counts[p]
    assert got == want


def test_blank_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, ""), (4, None)], "i int, k string")
    kept, _ = shape.dedup_first(rows, ["k"], [F.col("i")])
    assert sorted(r["i"] for r in kept.collect()) == [1, 3, 4]
    kept, bad = shape.dedup_first(rows, ["k"], [F.col("i")], blank="violation")
    assert [r["i"] for r in kept.collect()] == [1] and sorted(r["i"] for r in bad.collect()) == [3, 4]


def test_category_fails_closed(spark):
    rows = spark.createDataFrame([(1, "normal"), (2, None), (3, "unknown")], "i int, t string")
    kept, counts = filters.of_category(rows, "t", "unknown")
    assert kept.count() == 0 and counts.where("selected").count() == 0


def test_ambiguous_matches(spark):
    rows = spark.createDataFrame([("a", 1, True), ("a", 2, True), ("b", 3, False), ("c", 4, True), ("c", 5, False)], "item string, r int, ok boolean")
    assert sorted(r["r"] for r in match.disambiguate(rows, "item", F.col("ok")).collect()) == [3, 4]


def test_conflicting_patches(spark):
    rows = spark.createDataFrame([("r", "name", "o", "a"), ("r", "name", "o", "b"), ("r", "years", "o", "c"), ("", "name", "o", "a")], "record_id string, field string, current string, proposed string")
    got = {r["field"]: (r["proposed"], r["conflict"]) for r in updates.consolidate(rows).collect()}
    assert got == {"name": (None, "a | b"), "years": ("c", None)}


def test_dual_keys_disagree(spark):
    kids = spark.createDataFrame([(1, "a", "b"), (2, "a", "a"), (3, None, "b"), (4, None, None)], "i int, x string, y string")
    parents = spark.createDataFrame([("a",), ("b",)], "p string")
    got = {r["i"]: (r["target"], r["reason"]) for r in relate.resolve_dual_fk(kids, ("x", parents, "p"), ("y", parents, "p")).collect()}
    assert got == {1: (None, "targets disagree"), 2: ("a", None), 3: ("b", None), 4: (None, "no target")}


def plain_lists(t, mark):
    """Lists of a text read mark by mark: an entry goes on to the next mark that is one of its list."""
    marks, out, lst, n = list(re.finditer(mark, t)), [], 0, 0
    for i, m in enumerate(marks):
        entry = t[m.end() : marks[i + 1].start() if i + 1 < len(marks) else len(t)]
        k = int(m[1])
        if k == 1 or lst and k == n + 1:
            lst, n = lst + (k == 1), k
            out.append([lst, k, entry])
        elif out:
            out[-1][2] += f" {k} {entry}"
    tidy = [(a, b, re.sub(r"^[ ,;.]+|[ ,;.]+$", "", " ".join(e.split()))) for a, b, e in out]
    blank = {a for a, _, e in tidy if not e}
    return sorted(x for x in tidy if x[0] not in blank)


def test_numbered_lists_mark_by_mark(spark):
    rng = random.Random(5)
    texts = [" ".join(f"{rng.choice([1, 2, 3, 4, 5, n])}. w{n}" for n in range(1, size)) for size in (2, 9, 63, 64, 65, 66, 130, 400)]
    texts += ["", None, "no marks", "7) a 8) b", "1) only", "1. a 1. b 2. c 9. d 3. e", " ".join(f"{i % 900 + 1}. x" for i in range(6000)), "1. a " + " ".join(f"{i}: y" for i in range(3, 999)) + " 2. b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    got = {}
    for r in extract.numbered(docs, "id", "t").collect():
        got.setdefault(r["id"], []).append((r["list"], r["n"], r["entry"]))
    assert {k: sorted(v) for k, v in got.items()} == {i: x for i, t in enumerate(texts) if (x := plain_lists(t or "", extract._MARK))}


def test_inventory_of_the_part_table(spark):
    parts = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.01/part.parquet").collect()]
    want, taken = set(), {}
    for r in sorted(parts, key=lambda r: r["p_partkey"]):
        own = taken.setdefault((r["p_brand"], r["p_type"]), set())
        n = r["p_size"] % 5
        if n in own:
            n = r["p_partkey"]
        while n in own:
            n += 1
        own.add(n)
        want.add((r["p_brand"], r["p_partkey"], r["p_type"], n))
    rows = extract_queries.e_inventory(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(parts) and {(r["page"], r["slot"], r["status"], r["public"]) for r in rows} == want
    assert any(r["public"] != r["number"] for r in rows)
    odd = spark.createDataFrame([("p", "99999999999;;a;x;1\n;;b;x;1\n3;2;c;x;0\n3;2;d;x;5\n99999999999;2;e;x;1")], "page_id string, html string")
    got = {r["name"]: (r["slot"], r["public"], r["quantity"]) for r in extract.inventory(odd, r"(?m)^(\d*);(\d*);([^;]*);([^;]*);(\d+)$").collect()}
    assert got == {"a": (None, None, 1), "b": (None, None, 1), "c": (3, 2, None), "d": (3, 3, 5), "e": (None, 4, 1)}


def test_asymmetric_candidates_of_the_part_table(spark):
    parts = [r.asDict() for r in spark.read.parquet("/root/testdata/sf0.01/part.parquet").collect()]
    want = set()
    for a in parts:
        if a["p_partkey"] % 2 == 0:
            continue
        found = []
        for b in parts:
            if b["p_partkey"] % 2 or a["p_brand"] != b["p_brand"] or a["p_size"] != b["p_size"]:
                continue
            like = SequenceMatcher(None, a["p_name"], b["p_name"]).ratio()
            if a["p_name"] != b["p_name"] and like < 0.7:
                continue
            x, y = a["p_type"], b["p_type"]
            found.append(((5 if a["p_name"] == b["p_name"] else 3 * like) + (5 if x == y else 2.5 if x in y or y in x else 0), -b["p_partkey"]))
        want |= {(a["p_partkey"], -k, round(p, 6), i) for i, (p, k) in enumerate(sorted(found, reverse=True)[:3], 1) if p > 0}
    rows = relation_queries.m_top_candidates_difflib(spark, "/root/testdata/sf0.01").collect()
    assert {(r["item_id"], r["record_id"], round(r["points"], 6), r["rank"]) for r in rows} == want
    assert len(want) > 50


def test_manifests_with_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert writers.verify_manifest(writers.manifest(df, ["k"]), writers.manifest(df, ["k"]), ["k"]).count() == 0
    bad = writers.verify_manifest(writers.manifest(df, ["k"]), writers.manifest(df.where("v <> 3"), ["k"]), ["k"]).collect()
    assert [(r["k"], r["expected_rows"], r["actual_rows"]) for r in bad] == [(None, 2, 1)]


def test_numbered_lists(spark):
    docs = spark.createDataFrame([(1, "A: 1. sun 2. moon with 5. stars 3. sea 1. cat, 2. dog Reverse for all: crown"), (2, "no list"), (3, None)], "id int, t string")
    got = [(r["list"], r["n"], r["entry"]) for r in extract.numbered(docs, "id", "t", shared="Reverse for all").orderBy("list", "n").collect()]
    assert got[:3] == [(1, 1, "sun"), (1, 2, "moon with 5 stars"), (1, 3, "sea")]
    assert got[3:] == [(2, 1, "cat / Reverse for all: crown"), (2, 2, "dog / Reverse for all: crown")]


def test_page_sections(spark):
    html = '<table class="coin"><td>1 cent</td></table><header><h2>A › B › 1957 - 1990</h2></header><p class="period-hint">1 crown</p><table class="coin"><td>2 &amp; 3 cents<table><td>x</td></table></td></table>'
    blocks = extract.page_blocks(spark.createDataFrame([(1, html), (2, None)], "page_id int, html string"), {"header": ("header", ""), "hint": ("p", "period-hint"), "item": ("table", "coin")})
    got = [(r["text"], r["section"], r["hint"], r["warning"]) for r in extract.catalogue_items(blocks, fallback=F.lit("?")).orderBy("pos").collect()]
    assert got == [("1 cent", "?", None, "before any header"), ("2 & 3 centsx", "A › B › 1957 - 1990", "1 crown", None)]


def test_items_go_to_the_section_of_their_id(spark):
    blocks = [(1, 0, "item", "a", "9"), (1, 1, "header", "A › B › 1900 - 1910", None), (1, 2, "hint", "crowns", None), (1, 3, "item", "b", "1"), (1, 4, "header", "no years", None), (1, 5, "item", "c", None), (1, 6, "header", "A › C › 1910 - 1920", None), (1, 7, "item", "d", "2"), (1, 8, "item", "e", "1"), (1, 9, "item", "f", "7")]
    rows = extract.section_items(spark.createDataFrame(blocks, "page_id int, pos int, kind string, text string, pid string"), F.col("text").rlike(r"›.*\d{4}\s*-\s*\d{4}"), F.col("pid"))
    got = {r["text"]: (r["section"], r["section_id"], r["hint"], r["warning"]) for r in rows.collect()}
    assert got == {"a": (0, "9", None, "before any header"), "b": (1, "1", "crowns", None), "c": (1, "1", "crowns", None), "d": (2, "2", None, None), "e": (1, "1", None, "section differs"), "f": (None, "7", None, "section differs")}


def test_table_rows(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>a</td> | <td>b</td></tr><tr><td>c</td></tr></table>")], "page_id int, html string")
    assert [r["cells"] for r in extract.table_rows(pages).orderBy("row").collect()] == [["a", "b"], ["c"]]


def test_inventory_settles_numbers(spark):
    pages = spark.createDataFrame([(1, "1;4;a;on;2\n2;4;b;on;0\n3;2;c;on;1\n4;4;d;off;1")], "page_id int, html string")
    got = {r["name"]: (r["public"], r["quantity"]) for r in extract.inventory(pages, r"(?m)^(\d+);(\d+);([^;]*);([^;]*);(\d+)$").collect()}
    assert got == {"a": (4, 2), "b": (2, None), "c": (3, 1), "d": (4, 1)}


def test_incomplete_pages_give_no_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "p int, x string")
    ok, bad = extract.check_complete(rows, spark.createDataFrame([(1, 2), (2, 2), (3, 1)], "p int, n int"), "p", "n")
    assert {r["p"] for r in ok.collect()} == {1} and {r["p"] for r in bad.collect()} == {2, 3}


def test_statistics_have_every_category(spark):
    rows = spark.createDataFrame([("x", "scarce", 1900, None), ("x", "scarce", None, 1950), ("x", "pending", 1, 2)], "c string, a string, f int, l int")
    got = {r["a"]: (r["items"], r["first"], r["last"]) for r in stats.availability_stats(rows, ["c"], "a", "f", "l").collect()}
    assert got == {"circulating": (0, None, None), "scarce": (2, 1900, 1950), "withdrawn": (0, None, None), "historical": (0, None, None)}


def test_contracts(spark):
    rows = spark.createDataFrame([("a", 0), ("b", 2)], "k string, n int")
    assert [r["k"] for r in contracts.check_sequence(rows.withColumn("p", F.lit(1)), ["p"], "n").collect()] == ["b"]
    assert contracts.check_schema(rows, required=["k"], block=["n", "m"]).collect()[0]["problem"] == "block is not whole"
    audit = contracts.audit({"a": (rows, 2), "b": (rows, 0)})
    assert {r["check"]: r["status"] for r in audit.collect()} == {"a": "ok", "b": "blocked"}


def test_diff_sees_nulls(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, "y", "z")], "i int, p string, q string")
    b = spark.createDataFrame([(1, "n", "x"), (3, "y", "z")], "i int, p string, q string")
    got = {r["i"]: (r["status"], r["changed"]) for r in findings.snapshot_diff(a, b, ["i"], ["p", "q"]).collect()}
    assert got == {1: ("modified", ["p"]), 2: ("deleted", []), 3: ("created", [])}


def test_sources_and_sinks(spark, tmp_path):
    root = tmp_path / "cat" / "europe" / "land"
    root.mkdir(parents=True)
    (root / "app.json").write_text(json.dumps({"country": "Land", "periods": [{"title": "P", "coins": [{"denomination": "1 cent"}, {"denomination": "2 cents"}]}]}))
    other = tmp_path / "cat" / "asia" / "far"
    other.mkdir(parents=True)
    (other / "app.json").write_text("[broken")
    tree = readers.read_catalogue_tree(spark, str(tmp_path / "cat"), "app.json")
    assert [(r["continent_dir"], r["country_dir"], r["country"]) for r in tree.collect()] == [("europe", "land", "Land")]
    _, bad = readers.read_catalogue(spark, str(tmp_path / "cat" / "*" / "*"))
    assert bad.count() == 1
    flat = shape.flatten(tree, "periods", "coins", ["country"])
    writers.write_catalogue(flat, str(tmp_path / "out"), ["country"], ["group_title"], ["denomination"])
    back = spark.read.json(str(tmp_path / "out")).first()
    assert [x["denomination"] for x in back["groups"][0]["items"]] == ["1 cent", "2 cents"]
    files = readers.list_files(spark, str(tmp_path / "cat"), "*.json")
    assert readers.discover_ready(files, "app.json", "final.json").count() == 2
    widths = writers.write_tabular(flat, str(tmp_path / "csv"), {"denomination": "Denomination"}).first()
    assert widths["Denomination"] == 14
    writers.write_statistics(flat.groupBy("country").count(), str(tmp_path / "stats"))
    assert spark.read.json(str(tmp_path / "stats")).first()["count"] == 2


def test_link_maps(spark, tmp_path):
    (tmp_path / "map.txt").write_text("cent-1:\n  front: http://x/1\n  back: http://x/2\ncent-2:\n  front: http://x/3\ncent-1:\n  front: http://x/4\n")
    got = [(r["slug"], r["side"], r["url"]) for r in readers.read_link_map(spark, str(tmp_path / "map.txt")).orderBy("pos").collect()]
    assert got == [("cent-1", "front", "http://x/1"), ("cent-1", "back", "http://x/2"), ("cent-2", "front", "http://x/3"), ("cent-1", "front", "http://x/4")]
    lines = spark.read.text(str(tmp_path / "map.txt"), wholetext=True).select(F.lit("f").alias("source_file"), F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    assert [r["slug"] for r in readers.repeated_headers(lines).collect()] == ["cent-1"]


def test_snapshots_tracking_reports(spark, tmp_path):
    (tmp_path / "coin.json").write_text('{"id":"1","x":1}\n{"id":"1"}\n{"y":2}\n')
    snap = readers.read_entity_snapshot(spark, str(tmp_path), ["coin"])
    assert snap.count() == 3 and readers.snapshot_problems(snap).count() == 2
    assert readers.read_tracking(spark, str(tmp_path / "none"), "a string").count() == 0
    for name, body in (("a", [{"country": "A"}]), ("b", {"country": "B"}), ("c", {"reports": [{"country": "C"}, {"country": "D"}]}), ("d", {"countries": [{"country": "E"}]})):
        (tmp_path / f"r-{name}.json").write_text(json.dumps(body))
    assert sorted(r["country"] for r in readers.read_reports(spark, str(tmp_path / "r-*.json"), "country string").collect()) == ["A", "B", "C", "D", "E"]


def test_exports_refuse_two_continents(spark, tmp_path):
    rows = spark.createDataFrame([("X", "EU", "coin", 1), ("X", "AS", "coin", 2)], "country string, continent string, kind string, i int")
    assert writers.write_country_exports(rows, str(tmp_path / "e")).count() == 1 and not (tmp_path / "e").exists()
    good = rows.where("continent = 'EU'").unionByName(spark.createDataFrame([(None, None, "setting", 3)], rows.schema))
    assert writers.write_country_exports(good, str(tmp_path / "e")).count() == 0
    assert {r["country"] for r in spark.read.parquet(str(tmp_path / "e")).collect()} == {"X", "__global__"}


def test_manifest_sees_changes(spark):
    rows = spark.range(100).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    assert writers.verify_manifest(writers.manifest(rows, ["k"]), writers.manifest(rows.repartition(7), ["k"]), ["k"]).count() == 0
    assert writers.verify_manifest(writers.manifest(rows, ["k"]), writers.manifest(rows.withColumn("v", F.when(F.col("v") == 4, 5).otherwise(F.col("v"))), ["k"]), ["k"]).count() == 1


def test_cache_and_checkpoint(spark):
    items = spark.createDataFrame([("a",), ("b",)], "k string")
    left, kept = incremental.todo(items, spark.createDataFrame([("a",), ("z",)], "k string"), ["k"])
    assert [r["k"] for r in left.collect()] == ["b"] and [r["k"] for r in kept.collect()] == ["a"]


def test_stream_upsert(spark, tmp_path):
    landed, target = tmp_path / "in", str(tmp_path / "table")
    landed.mkdir()
    schema = "k string, v int"
    for batch in ([("a", 1), ("b", 1)], [("b", 2), ("c", 2)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(landed))
        stream = spark.readStream.schema(schema).parquet(str(landed))
        query = upserts.stream_upsert(stream, target, ["k"], str(tmp_path / "check"))
        query.awaitTermination(120)
    assert {r["k"]: r["v"] for r in upserts.latest(spark, target).collect()} == {"a": 1, "b": 2, "c": 2}


def test_pairs_without_amounts_are_candidates(spark):
    schema = "id long, place string, amount string"
    items = spark.createDataFrame([(1, "a", None), (2, "a", ""), (3, "a", "5")], schema)
    records = spark.createDataFrame([(10, "a", None), (11, "a", ""), (12, "a", "5"), (13, "a", "6")], schema)
    got = match.top_candidates(items, records, ["place"], "amount", F.lit(1.0), 9, item_id="id", record_id="id")
    assert {(r["item_id"], r["record_id"]) for r in got.collect()} == {(i, r) for i in (1, 2) for r in (10, 11, 12, 13)} | {(3, 10), (3, 11), (3, 12)}


def test_last_wins_by_order_however_rows_lie(spark):
    old = spark.createDataFrame([(1, "o", 0), (2, "o", 0)], "k long, v string, at long")
    new = spark.createDataFrame([(1, f"n{i}", i % 4) for i in range(5)] + [(3, "x", 1), (3, "y", 1)], "k long, v string, at long")
    seen = set()
    for n in range(1, 5):
        rows = {r["k"]: r["v"] for r in shape.merge_last_wins(old, new.repartition(n), ["k"], order=["at"]).collect()}
        assert rows[1] == "n3" and rows[2] == "o"
        seen.add(rows[3])
        assert updates.upsert(old, new.repartition(n), ["k"], order=["at"]).count() == 3
        assert shape.copy_by_key(old, new.repartition(n), ["k"], ["v"], order=["at"]).where("k = 1").first()["v"] == "n3"
    assert len(seen) == 1


def test_new_checkpoint_goes_on_from_the_newest_version(spark, tmp_path):
    target = str(tmp_path / "t")
    for run in range(3):
        path = str(tmp_path / f"in{run}")
        spark.createDataFrame([(run, f"v{run}"), (9, f"v{run}")], "k long, v string").write.parquet(path)
        stream = spark.readStream.schema("k long, v string").parquet(path)
        upserts.stream_upsert(stream, target, ["k"], str(tmp_path / f"check{run}")).awaitTermination()
    assert {(r["k"], r["v"]) for r in upserts.latest(spark, target).collect()} == {(0, "v0"), (1, "v1"), (2, "v2"), (9, "v2")}


def test_descriptions_end_at_the_stops_given(spark):
    rows = spark.createDataFrame([("Eagle over a lake, Sold out since 1990",)], "t string")
    got = rows.select(extract.design_description(F.col("t"), [r"\bsold out\b"]).alias("a"), extract.design_description(F.col("t")).alias("b")).first()
    assert tuple(got) == ("Eagle over a lake", "Eagle over a lake, Sold out since 1990")


def test_technical_lines(spark):
    lines = ["Silver 0.900, 2,5 g, ø 20 mm KM# 12a · Coins", "steel 3g, ø19.5mm", "Gold", "7 g", None, "Zinc, KM#, Y#4, 3 mm", "Ø21 mm", "Lot 5#3, 4 g KM#7", "KM# A12·Coin", "KM#1#2", "Nickel (5 g), ø 20 mm", "5 gé 6 mmx XKM# 3", "Silver, 12 G ABCDEFGHI# 4"]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, s string").select("i", text.parse_technical(F.col("s")).alias("t")).orderBy("i").collect()
    assert [tuple(r["t"]) for r in rows] == [
        ("Silver 0.900", 2.5, 20.0, "KM", "12a", "Coins"), ("steel", 3.0, 19.5, None, None, None), (None,) * 6, (None, 7.0, None, None, None, None), (None,) * 6, (None, None, None, "Y", "4", None),
        (None, None, 21.0, None, None, None), ("Lot 5#3", 4.0, None, "KM", "7", None), (None, None, None, "KM", "A12", "Coin"), (None, None, None, "KM", "1#2", None), ("Nickel (", 5.0, 20.0, None, None, None),
        (None, None, None, "XKM", "3", None), ("Silver", 12.0, None, None, None, None),
    ]
