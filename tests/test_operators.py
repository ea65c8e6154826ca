"""Golden rows and invariants of the relational operators."""

import random
from difflib import SequenceMatcher, get_close_matches

from pyspark.sql import functions as F

from tessera.operators import corrections, lineage, matching, ocr, temporal, validation, workqueue
from tessera.plans import workflows
from tessera.sources import dimensions, readers, writers

SAMPLE = """{"provincia":"BARI DELLE PUGLIE","comuni":[
{"numero_ordine":1,"comune":"Aaa","complesso_esercizi":3,"complesso_addetti":726,"commercio_esercizi":null,"commercio_addetti":2,"vendita_vino":3,"vendita_liquori":1},
{"numero_ordine":2,"comune":"Bbb","complesso_esercizi":4,"complesso_addetti":556,"commercio_esercizi":null,"commercio_addetti":5,"vendita_vino":0}],
"totale_provincia":{"complesso_esercizi":10,"complesso_addetti":1282,"commercio_esercizi":null,"commercio_addetti":7,"vendita_vino":3,"vendita_liquori":2}}"""


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_alive(spark):
    e = spark.createDataFrame([("a", "1900-01-01", "1950-01-01"), ("a", "1950-01-02", "9999-12-31"), ("b", None, "9999-12-31"), ("c", "1927-10-15", "1927-10-15")], "code string, s string, e string")
    e = e.select("code", F.col("s").cast("date").alias("start"), F.col("e").cast("date").alias("end"))
    sets = temporal.alive_sets(e, temporal.CENSUS_DATES | {"ref": temporal.REFERENCE_DATE})
    assert rows_of(sets) == [("1921", "a"), ("1927", "a"), ("1927", "c"), ("1929", "a"), ("ref", "a")]
    assert rows_of(temporal.alive_at(e, "1927-10-15")) == [("a",), ("c",)]
    assert rows_of(temporal.alive_drift(temporal.alive_counts(sets), {"1921": 1, "1927": 3, "x": 1})) == [("1927", 3, 2), ("x", 1, 0)]


def codes(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "code string")


def test_closure(spark):
    ref = codes(spark, "R1", "R2")
    edge = lambda *pairs: spark.createDataFrame(list(pairs), "src string, dst string")
    assert rows_of(lineage.closure(edge(("A", "B"), ("B", "R1")), ref)) == [("A", "R1"), ("B", "R1")]
    assert rows_of(lineage.closure(edge(("A", "B"), ("A", "C"), ("B", "R1"), ("C", "R2")), ref)) == [("A", "R1"), ("A", "R2"), ("B", "R1"), ("C", "R2")]
    assert rows_of(lineage.closure(edge(("A", "B"), ("B", "A")), ref)) == []
    assert rows_of(lineage.closure(edge(("R1", "R2"), ("A", "R1")), ref)) == [("A", "R1")]
    chain = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(10)] + [("n10", "R1")]
    reached = {r[0] for r in rows_of(lineage.closure(edge(*chain), ref))}
    assert "n01" in reached and "n00" not in reached


def test_bridge_takes_the_first_key(spark):
    rows = [("x", "k1", 0), ("R1", "k1", 1), ("x", "k2", 2), ("R2", "k2", 3), ("y", "k3", 4), ("R1", "k3", 5), ("R2", "k3", 6), ("z", "", 7), ("z", None, 8)]
    got = lineage.key_bridge(spark.createDataFrame(rows, "code string, key string, idx long"), codes(spark, "R1", "R2"))
    assert rows_of(got) == [("x", "R1")]


def test_cascade_and_classification(spark):
    ref = codes(spark, "000001", "000002", "000003")
    alive = spark.createDataFrame([("1921", c) for c in ("000001", "000010", "000011", "701000", "000012", "000013")] + [("1927", "000002")], "label string, code string")
    bridge = spark.createDataFrame([("000010", "000001")], "code string, dest string")
    reach = spark.createDataFrame([("000011", "000002"), ("000011", "000003")], "code string, dest string")
    rescue = spark.createDataFrame([("000012", "000003"), ("701000", "000001")], "code string, dest string")
    forward = lineage.forward_mapping(alive, ref, bridge, reach, rescue)
    assert dict(forward.where("label = '1921'").select("code", "method").collect()) == {"000001": "DIRECT", "000010": "CATASTALE", "000011": "SISTAT", "701000": "LOST_TERRITORY", "000012": "ANPR_FALLBACK", "000013": "UNTRACED"}
    done = {r["code"]: r for r in lineage.classify(forward, ref, alive, ["1921", "1927"], codes(spark, "000002")).collect()}
    assert (done["000001"]["mapping_1921"], done["000001"]["mapping_type"], done["000001"]["status"]) == ("000001|000010", "AGGREGATE", "USABLE")
    assert (done["000002"]["status"], done["000002"]["discard_reason"], done["000002"]["territory_transfer_flag"]) == ("DISCARD", "split_child_1921", True)
    assert not done["000001"]["traceable_all_years"] and len(done) == 3
    inverse = lineage.invert(forward, ref)
    assert inverse.count() == forward.select(F.explode("dest")).count()


def test_match_levels_are_total(spark):
    panel = spark.createDataFrame([(0, "ROMA", "Lazio"), (1, "ROMA", "Lazio"), (2, "SANT'AGATA", "Bolzano/Bozen"), (3, "PETESCIA", "Rieti"), (4, "UNICO", "X"), (5, "DOPPIO", "X"), (6, "DOPPIO", "Y")], "idx long, name string, province string")
    e = spark.createDataFrame([("1", "Roma", "LAZIO"), ("2", "Sant Agata", "Bolzano"), ("2b", "SantAgata", "Bolzano"), ("057071", "TURANIA", "Rieti"), ("4", "Unico", "Z"), ("5", "Doppio", "Z")], "code string, name string, province string")
    got = {r["code"]: (r["level"], r["panel_idx"]) for r in matching.match_cascade(e, panel, dimensions.PROVINCE_ALIASES, dimensions.NAME_OVERRIDES).collect()}
    assert got == {"1": ("exact", 1), "2": ("unmatched", None), "2b": ("fuzzy", 2), "057071": ("manual", 3), "4": ("name_only", 4), "5": ("unmatched", None)}


def test_fuzzy_agrees_with_the_library(spark):
    rng = random.Random(5)
    names = sorted({"".join(rng.choices("abcdef", k=rng.randint(1, 14))) for _ in range(120)})
    words = sorted({"".join(c for c in n if rng.random() > 0.08) + rng.choice(["", "", "a"]) for n in names} | {"abcdefgh", ""})
    names += ["abcdefgx", "abcdefgz", "abcdefga"]
    got = {r["word"]: r["name"] for r in matching.fuzzy_f1(spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    want = {w: m[0] for w in words if w and (m := get_close_matches(w, names, n=1, cutoff=0.85))}
    assert got == want and got["abcdefgh"] == "abcdefgz"
    pool = spark.createDataFrame(list(enumerate(names)), "idx long, name string")
    for r in matching.fuzzy_f2(spark.createDataFrame([(w,) for w in words[:25]], "word string"), pool).collect():
        scores = [SequenceMatcher(None, r["word"], n).ratio() for n in names]
        assert r["score"] == max(scores) and r["name"] == (names[scores.index(max(scores))] if max(scores) >= 0.75 else None)


def test_linking_widens_only_what_is_open(spark):
    panel = spark.createDataFrame([(0, "P", "ALFA"), (1, "Q", "ALFA"), (2, "Q", "BETAMAXIMA"), (3, None, "GAMMA")], "idx long, province string, norm string")
    rows = spark.createDataFrame([(1, "Q", "ALFA"), (2, "P", "BETAMAXIMA"), (3, "P", "BETAMAXIMO"), (4, None, "ALFA"), (5, "P", "NOTHING"), (6, "Q", "GAMMA")], "row_id long, province string, norm string")
    assert rows_of(matching.link_names(rows, panel)) == [(1, "exact", 1), (2, "exact", 2), (3, "fuzzy", 2), (4, "exact", 0), (5, "no_ref", None), (6, "exact", 3)]


def test_region_stages_agree_with_the_library(spark):
    """Region first, then the whole panel if strictly better; a region without names of its own has the whole panel."""
    rng = random.Random(9)
    name = lambda: "".join(rng.choices("ABCDE", k=rng.randint(0, 9)))
    panel = [(i, rng.choice(["North", "South", None]), name()) for i in range(70)]
    rows = [(i, rng.choice(["North", "South", "Nowhere", None]), name()) for i in range(60)]
    got = {r[0]: r[1:] for r in rows_of(matching.link_regions(spark.createDataFrame(rows, "row_id long, region string, norm string"), spark.createDataFrame(panel, "idx long, region string, norm string"), {"North": ["north"]}))}
    everyone = list(dict.fromkeys(n for _, _, n in panel))

    def best(word, names):
        scores = [SequenceMatcher(None, word, n).ratio() for n in names]
        top = max(scores, default=0.0)
        return (names[scores.index(top)] if top >= 0.75 else None), top

    for i, region, word in rows:
        if word in everyone:
            assert got[i] == ("exact", word, 1.0)
            continue
        found, score = best(word, list(dict.fromkeys(n for _, r, n in panel if r == region and r)) or everyone)
        if score < 0.85:
            other = best(word, everyone)
            if other[1] > score:
                found, score = other
        assert got[i] == (("fuzzy", found, score) if found and score >= 0.85 else ("none", None, score)), (i, region, word)


def test_regions(spark):
    panel = spark.createDataFrame([(0, "Puglia", "BARI"), (1, "Lazio", "ROMA")], "idx long, region string, norm string")
    rows = spark.createDataFrame([(1, "Puglie", "BARI"), (2, "Puglie", "BARRI"), (3, "Puglie", "XYZ")], "row_id long, region string, norm string")
    got = rows_of(matching.link_regions(rows, panel, dimensions.REGION_PROVINCES))
    assert [(r[0], r[1], r[2]) for r in got] == [(1, "exact", "BARI"), (2, "fuzzy", "BARI"), (3, "none", None)]
    assert rows_of(matching.reconcile(rows, spark.createDataFrame([("BARI",), ("ROMA",)], "norm string"), "norm")) == [("BARI", "matched"), ("BARRI", "left_only"), ("ROMA", "right_only"), ("XYZ", "left_only")]


def test_documents(spark):
    texts = spark.createDataFrame([("a", SAMPLE), ("skip", '{"_skip": true, "_reason": "r"}'), ("bad", "{"), ("none", '{"provincia": "x", "comuni": 5}'), ("types", '{"provincia":"x","comuni":[{"comune":"c","numero_ordine":"q"}]}')], "file string, value string")
    made = workflows.validate_documents(texts)
    assert dict(made["verdicts"].select("file", "result").collect()) == {"a": "FAIL", "skip": "SKIP", "bad": "FAIL", "none": "FAIL", "types": "FAIL"}
    assert rows_of(made["totals"]) == [("a", "complesso_esercizi", 10, 7, 3), ("a", "vendita_liquori", 2, 1, 1)]
    messages = [r[1] for r in made["schema"].where("file = 'types'").collect()]
    assert len(messages) == 6 and "comuni[0] (c): 'numero_ordine' should be int|null" in messages
    rows = validation.document_rows(validation.parse_documents(texts).where("file = 'a'"))
    assert rows_of(validation.detect_field(rows)) == [("a", "NEW", "complesso_addetti")]


def test_legacy_fields(spark):
    make = lambda **k: '{"comuni":[' + ",".join("{" + ",".join(f'"{a}":{b}' for a, b in r.items()) + "}" for r in k["rows"]) + "]}"
    old = {"commercio_esercizi": 1, "industria_addetti": 2, "vendita_liquori": 3}
    texts = [("c", make(rows=[old | {"commercio_esercizi": "null"}])), ("b", make(rows=[old | {"industria_addetti": "null"}])), ("a", make(rows=[old | {"vendita_liquori": "null"}])), ("u", make(rows=[old])), ("n", make(rows=[old | {"complesso_addetti": "null"}]))]
    rows = validation.document_rows(validation.parse_documents(spark.createDataFrame(texts, "file string, value string")))
    got = {r["file"]: (r["phase"], r["field"]) for r in validation.detect_field(rows).collect()}
    assert got == {"c": ("LEGACY_C", "industria_addetti"), "b": ("LEGACY_B", "industria_esercizi"), "a": ("LEGACY_A", "industria_esercizi"), "u": ("LEGACY_UNK", "industria_esercizi"), "n": ("NEW", "complesso_addetti")}


def test_sequence_and_rates(spark):
    rows = spark.createDataFrame([("f", i, n) for i, n in enumerate([1, 2, 4, None, 5])], "file string, i int, n long")
    assert [(r["n"], r["expected"]) for r in validation.sequence_breaks(rows, "file", "i", "n").collect()] == [(4, 3)]
    s = spark.createDataFrame([("a", "csv_empty")] + [("b", "match")] * 9 + [("b", "mismatch")] + [("c", "mismatch")], "file string, value_status string")
    rates = validation.match_rates(s, "file")
    assert rows_of(rates) == [("a", 1, 0, 0, 1.0), ("b", 10, 10, 9, 0.9), ("c", 1, 1, 0, 0.0)]
    assert [r["file"] for r in validation.review_gate(rates).collect()] == ["c"]


def test_ocr_rows(spark):
    page = "\n".join([
        "CIRCONDARIO DI BARI.", "| COMUNI | a | b | c | d | e | f |", "|---|---|---|---|---|---|---|", "| Acquaviva | 9896 | 4810 | 5086 | 5695 | 2800 | 2895 |",
        "| Bb | 9900 | .. | 5086 | 5695 | 1 | 2 |", "| X |  | 10 | 20 | 15 | 1 | 2 | 3 |", "| Montagna in V | 1 | 2 | 3 | 4 | 5 | 6 |", "| Cc | 1 | 2 |", "| Dd | 12-34 | 1 | 2 | 3 | 4 | 5 |",
    ])
    pages = spark.createDataFrame([("R", 0, page), ("R", 1, "| Ee | 1 | 2 | 3 | 1 | 5 | 6 |\nCircondario di Altamura ..\n| Ff | 1 | 2 | 3 | .. | 5 | 6 |")], "region string, page int, markdown string")
    got = ocr.parse_region_pages(pages).select("comune_raw", "popres_1921_tot", "popres_1921_f", "analfabeti_1921", "circondario")
    assert rows_of(got) == [("Acquaviva", 9896, 5086, 4201, "BARI"), ("Bb", 9900, 5086, 4205, "BARI"), ("Ee", 5, 3, 4, "BARI"), ("Ff", 5, 3, None, "Altamura"), ("X", 35, 15, 34, "BARI")]


def test_corrections(spark):
    rows = spark.createDataFrame([(1, "f", "Forlì", 5), (2, "f", "Bari", None), (3, "g", "Bari", 7)], "row_id long, file string, name string, value long")
    fixes = corrections.parse_corrections(spark.createDataFrame([('{"f": {"forlì": 9, "Bari": {"corrected_name": "Bari 2", "ind_workers": 4.0}}}',)], "value string"))
    assert rows_of(corrections.apply_corrections(rows, fixes).select("row_id", "name", "value", "value_fixed", "name_fixed")) == [(1, "Forlì", 9, True, False), (2, "Bari 2", 4, True, True), (3, "Bari", 7, False, False)]
    chain = spark.createDataFrame([("f", "a", None, "b"), ("f", "b", None, "c")], "file string, name string, new_value long, new_name string")
    assert rows_of(corrections.rename_chains(chain)) == [("f", "a", "b")]
    table = spark.createDataFrame([("A", None), ("B", 1.0), ("C", None)], "norm string, w double")
    filled = corrections.backfill(table, spark.createDataFrame([("A", 5), ("B", 6)], "norm string, fill long"), "w")
    assert rows_of(filled) == [("A", 5.0, True), ("B", 1.0, False), ("C", None, False)]
    assert rows_of(corrections.fill_counts(table, "w", filled)) == [(2, 1, 1)]
    assert rows_of(corrections.coverage(table, ["norm", "w"])) == [("norm", 3, 3, 100.0), ("w", 1, 3, 33.3)]


def test_queue(spark):
    inventory = workqueue.pair_inventory(spark, 6)
    outputs = spark.createDataFrame([("pair_0000", False), ("pair_0001", True), ("extra", False)], "id string, skipped boolean")
    locks = spark.createDataFrame([("pair_0002",), ("pair_0000",)], "id string")
    assert rows_of(workqueue.queue_status(inventory, outputs, locks)) == [(6, 2, 1, 1, 3, "pair_0003")]
    pages = spark.createDataFrame([(f"p{i:03d}",) for i in range(101)], "name string")
    got = rows_of(workqueue.page_pairs(pages).select("left_page", "right_page"))
    assert got == [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(0, 100, 2)]
    keys = spark.createDataFrame([("a_p10",), ("a_p2",), ("b_p1",), ("a_p1",)], "key string")
    done = spark.createDataFrame([("a_p1",)], "key string")
    assert [r[0] for r in workqueue.next_batch(keys, done, 2).collect()] == ["a_p10", "a_p2"]
    assert rows_of(workqueue.page_range(spark.createDataFrame([("v", 3, 5)], "volume string, first int, last int"))) == [("v", 3), ("v", 4), ("v", 5)]


def test_workflows_from_files(spark, tmp_path):
    reg = tmp_path / "reg.csv"
    reg.write_text("CODISTAT,CODCATASTALE,DENOMTRASLITTERATA,SIGLAPROVINCIA,DATAISTITUZIONE,DATACESSAZIONE\n1,A1,ROMA,RM,1900-01-01,9999-12-31\n2,A2,ANTICA,NA,1900-01-01,1928-01-01\n3,A2,NUOVA,NA,1928-01-02,9999-12-31\n4,A4,PERSA,NA,1900-01-01,1930-01-01\n")
    lines = tmp_path / "lin"
    lines.mkdir()
    for name, text in {"comuni": "sistat_id\tlast_istat_cod\n9\t4\n", "event_extinction": "sistat_id\tevent_to_istat_cod\n9\t1.0\n", "event_creation": "event_from_istat_cod\n1\n", "comuni_variations": "sistat_id\tevent_num\tevent_type\tevent_date\n9\t1\tterritory_cession\t1925-01-01\n", "event_territory_acquisition": "event_num\tevent_from_istat_cod\n1\t3\n", "event_territory_cession": "event_num\tevent_to_istat_cod\n2\t1\n"}.items():
        (lines / f"{name}.tab").write_text(text)
    panel_file = tmp_path / "panel.csv"
    panel_file.write_text("comune_matchable_50,region,province,popres_1921_tot,popres_1921_f,analfabeti_1921,ind_workers_1927,agri_workers_1929\nROMA,Lazio,Roma,10,5,1,100,\nNUOVA,Campania,Napoli,1,1,1,,2\n")
    registry, panel = readers.read_registry(spark, str(reg)), readers.read_panel(spark, str(panel_file))
    assert registry.where("sigla = 'NA'").count() == 3
    made = workflows.build_crosswalk(registry, readers.read_lineage(spark, str(lines)), panel)
    got = {r["codistat_1950"]: r for r in made["crosswalk"].collect()}
    assert got["000001"]["mapping_1921"] == "000001|000004" and got["000003"]["mapping_1921"] == "000002"
    assert got["000003"]["territory_transfer_flag"] and got["000003"]["csv_name_match"] == "NUOVA" and got["000001"]["level"] == "exact"
    assert "USABLE: 2" in writers.render_summary(made["crosswalk"].withColumnRenamed("codistat_1950", "code"), made["forward"])
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "pair_0001.json").write_text('{"provincia":"NAPOLI","comuni":[{"numero_ordine":1,"comune":"Nuova","complesso_addetti":7},{"numero_ordine":2,"comune":"Rroma","complesso_addetti":120}]}')
    (docs / "pair_0002.json").write_text("{")
    linked = workflows.link_extractions(readers.read_documents(spark, str(docs)), panel)
    assert rows_of(linked["linked"].select("comune", "match_status")) == [("Nuova", "exact:csv_empty"), ("Rroma", "fuzzy:mismatch")]
    assert rows_of(linked["problems"]) == [("pair_0002.json", "unreadable")] and linked["review"].count() == 1
    fixes = corrections.parse_corrections(spark.createDataFrame([('{"pair_0001.json": {"Rroma": 101}}',)], "value string"))
    done = workflows.correct_and_fill(linked["linked"], fixes, panel)
    assert rows_of(done["corrected"].select("comune", "ind_workers_1927", "match_status")) == [("Nuova", 7, "exact:csv_empty"), ("Rroma", 101, "fuzzy:match")]
    assert rows_of(done["panel"].select("comune_matchable_50", "ind_workers_1927", "filled")) == [("NUOVA", 7.0, True), ("ROMA", 100.0, False)]
    pages = spark.createDataFrame([("Lazio", 0, "| Roma | 10 | 5 | 5 | 9 | 1 | 1 |\n| Zzzz | 10 | 5 | 5 | 9 | 1 | 1 |")], "region string, page int, markdown string")
    pop = workflows.link_population(pages, panel)
    assert rows_of(pop["linked"].select("comune_raw", "match_type")) == [("Roma", "exact"), ("Zzzz", "none")]
    assert rows_of(pop["checks"].select("field", "same")) == [("analfabeti_1921", True), ("popres_1921_f", True), ("popres_1921_tot", True)]
    assert writers.population_rows(pop["linked"]).count() == 2


def test_stream(spark, tmp_path):
    from tessera.streaming.queue import run_queue

    (tmp_path / "in").mkdir()
    for i in range(5):
        (tmp_path / "in" / f"d{i}.json").write_text(SAMPLE if i else "{")
    for _ in range(2):  # the second run finds nothing new
        run_queue(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), 2).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 5 and got.select("batch").distinct().count() == 3


def test_ledger_reader(spark, tmp_path):
    assert readers.read_or_empty(spark, str(tmp_path / "none")).count() == 0
    row = spark.createDataFrame([("a", 1, 1, 1, "CONFIRMED", None)], readers.LEDGER)
    for _ in range(2):
        writers.append_ledger(row, str(tmp_path / "l"))
    assert rows_of(workqueue.ledger_report(readers.read_or_empty(spark, str(tmp_path / "l"))))[0][:2] == (2, 2)


def test_field_accuracy_and_correction_counts(spark):
    links = spark.createDataFrame([("a", "exact"), ("b", "fuzzy"), ("c", "exact")], "name string, match_type string")
    checks = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("b", None)], "name string, equal boolean")
    one, two = spark.createDataFrame([("x",)], "name string"), spark.createDataFrame([], "name string")
    assert tuple(validation.field_accuracy(links, checks, one, two).first()) == (2, 1, 1, 0, 4, 2, 50.0)
    assert validation.field_accuracy(links, checks.limit(0), one, two).first()["accuracy"] is None
    before = spark.createDataFrame([("exact:match",), ("no_ref",), ("no_ref",), (None,)], "match_status string")
    after = spark.createDataFrame([("exact:match",), ("exact:match",), ("no_ref",)], "match_status string")
    got = {tuple(r) for r in corrections.correction_counts(before, after).collect()}
    assert got == {("exact:match", 1, 2), ("no_ref", 2, 1), (None, 1, 0)}


def test_fields_of_new_and_legacy_documents(spark):
    rows = spark.createDataFrame([('{"complesso_addetti": 5, "vendita_vino": "7"}',), ('{"industria_addetti": 3.0, "commercio_addetti": null}',)], "t string").select(F.try_parse_json("t").alias("row"))
    new, old = (r["f"].asDict() for r in rows.select(validation.all_fields().alias("f")).collect())
    assert new["complesso_addetti"] == 5 and new["vendita_vino"] == 7 and new["industria_addetti"] is None
    assert old["industria_addetti"] == 3 and old["commercio_addetti"] is None and set(old) == set(validation.NEW_FIELDS + validation.OLD_FIELDS)


def test_manifest_keeps_the_first_rows(spark):
    rows = spark.createDataFrame([("f", i, i % 3 != 0) for i in range(40)] + [("g", 1, True)], "file string, line long, bad boolean")
    gate = spark.createDataFrame([("f", 0.1), ("h", 0.2)], "file string, match_rate double")
    got = {r["file"]: ([m["line"] for m in r["mismatches"]], r["n_more"]) for r in validation.review_manifest(rows, gate, "file", ["line"], F.col("bad"), "line", 4).collect()}
    assert got == {"f": ([1, 2, 4, 5], 22), "h": ([], 0)}
