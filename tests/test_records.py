"""Record operators: rules, merges against plain Python, validation, responses, reports."""

import itertools
import json
import random

from pyspark.sql import functions as F

from marlstone.functions.lexicon import Vocabulary, abbreviations
from marlstone.operators import consensus, evidence, link, mentions, records, report, response, rules, segment, validate
from marlstone.plans import pipeline
from marlstone.sources import files, responses
from marlstone.streaming.batches import run_stream


def one(spark, expression, *row):
    names = "abcdef"
    return spark.createDataFrame([row], ", ".join(f"{names[i]} string" for i in range(len(row)))).select(expression).first()[0]


def test_rules(spark):
    A, B = F.col("a"), F.col("b")  # noqa: N806
    assert one(spark, rules.solvent(A), "meoh and ipa") == "Methanol / Isopropanol"
    assert one(spark, rules.solvent(A), "MEK / cyclohexane") == "Mek / Cyclohexane"
    assert one(spark, rules.solvent(A), "methyl ethyl ketone, cyclohexane") == "Butanone / Cyclohexane"
    assert one(spark, rules.solvent(A), "chloroform with a drop of x") == "Chloroform"
    assert one(spark, rules.both_shares(A, B), "8", "A / B") == "92/8"
    assert one(spark, rules.both_shares(A, B), "70", "A / B") == "70/30"
    assert one(spark, rules.both_shares(A, B), "8", "A") == "8"
    assert one(spark, rules.both_shares(A, B), "60/40", "A / B") == "60/40"
    assert one(spark, rules.ratio_in_solvent(A), "60/40 v/v")["ratio"] == "40"
    assert one(spark, rules.pore_of_phantom(F.lit(None).cast("string"), A), "100 A") == "100A A"
    assert one(spark, rules.pore_of_phantom(F.lit(None).cast("string"), A, False), "100 A") == "100 A"
    assert one(spark, rules.real_column(A), "100 A") is None
    assert one(spark, rules.real_column(A), "Nucleosil C18") == "Nucleosil C18"
    assert one(spark, rules.column_name(A), "of C18 nucleosol") == "C18 Nucleosil"
    assert one(spark, rules.injection_volume(A), "5 wt%") is None
    assert one(spark, rules.inferred_column(F.array(A)), "on a brandx C 18 column") == "Brandx C18"
    assert one(spark, rules.phase(F.lit(None).cast("string"), A, B, B), "x", "diol") == "Normal phase"
    assert one(spark, rules.ratio_units(A, B), "w/w", "Acetone / Water") == "wt% acetone"


def greedy(rows, keys, merge):
    kept = []
    for row in rows:
        for k in kept:
            if all(k[f] is None or row[f] is None or k[f] == row[f] for f in keys):
                merge(k, row)
                break
        else:
            kept.append(dict(row))
    return kept


def test_null_tolerant_merge(spark):
    r = random.Random(5)
    keys = ("critical_polymer_unit", "ratio")
    docs = {0: [("a", None), ("a", "60/40"), ("a", "54/46"), (None, "54/46"), ("b", None)]}
    for d in range(1, 40):
        docs[d] = [(r.choice([None, "a", "b"]), r.choice([None, "1/2", "3/4"])) for _ in range(r.randint(1, 7))]
    rows = [(d, i, u, q, f"v{i}" if i % 2 else None) for d, xs in docs.items() for i, (u, q) in enumerate(xs)]
    df = spark.createDataFrame(rows, "doc_id bigint, ord int, critical_polymer_unit string, ratio string, note string")
    got = consensus.null_tolerant_merge(df, keys).orderBy("doc_id", "kept_idx").collect()

    def fill(k, row):
        for f in ("critical_polymer_unit", "ratio", "note"):
            k[f] = row[f] if k[f] is None else k[f]

    want = []
    for d, xs in sorted(docs.items()):
        own = [{"doc_id": d, "ord": i, "critical_polymer_unit": u, "ratio": q, "note": f"v{i}" if i % 2 else None} for i, (u, q) in enumerate(xs)]
        want += [tuple(k[f] for f in ("doc_id", "ord", "critical_polymer_unit", "ratio", "note")) for k in greedy(own, keys, fill)]
    assert [(g.doc_id, g.ord, g.critical_polymer_unit, g.ratio, g.note) for g in got] == want


def test_fuzzy_merge(spark):
    rows = [(1, 1, "p", None, "thf", "80", "rp"), (1, 2, "p", "m", "thf", "84", "rp"), (1, 3, "p", "m", "thf", "90", "rp"), (1, 4, "q", None, None, None, "rp"), (2, 1, None, None, None, None, None), (2, 2, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, ord int, critical_polymer_unit string, manufacturer string, solvent string, ratio string, phase string")
    got = consensus.fuzzy_merge(df, ("critical_polymer_unit", "manufacturer", "solvent", "ratio", "phase")).orderBy("doc_id", "kept_idx").collect()
    assert [(g.doc_id, g.manufacturer, g.ratio) for g in got] == [(1, "m", "84"), (1, "m", "90"), (1, None, None), (2, None, None), (2, None, None)]


def test_agreement_and_link(spark):
    rows = [(1, 1, "p", "6 C", "a"), (1, 2, "p", "37 C", "b"), (1, 3, "q", None, "a")]
    df = spark.createDataFrame(rows, "doc_id bigint, ord int, critical_polymer_unit string, temperature string, model string").withColumn("column_name", F.lit("Jordi"))
    assert [r.ord for r in consensus.agreed(df, 2, ("critical_polymer_unit",)).orderBy("ord").collect()] == [1, 2]
    merged = link.keyed_merge(df).orderBy("ord").collect()
    assert [(m.critical_polymer_unit, m.temperature) for m in merged] == [("p", "6-37 C"), ("q", None)]
    assert link.linked(df).count() == 2


def windows_of(sizes, limit, overlap=1):
    out, at = [], 0
    while at < len(sizes):
        end, used = at, 0
        while end < len(sizes) and (end == at or used + sizes[end] <= limit):
            used += sizes[end]
            end += 1
        out.append((at, end))
        if end >= len(sizes):
            break
        at = max(end - overlap, at + 1)
    return out


def test_chunks(spark):
    r = random.Random(2)
    texts = {d: [("column " + "x" * r.randint(15, 700)) for _ in range(r.randint(1, 12))] for d in range(25)}
    rows = [(d, i, p) for d, ps in texts.items() for i, p in enumerate(ps)]
    got = segment.chunks(spark.createDataFrame(rows, "doc_id bigint, para_idx int, para string"), Vocabulary(), max_chars=900).orderBy("doc_id", "chunk_id").collect()
    want = [(d, a, b - 1) for d, ps in sorted(texts.items()) for a, b in windows_of([len(p) + 2 for p in ps], 900)]
    assert [(g.doc_id, g.para_start, g.para_end) for g in got] == want
    assert all(len(g.raw_text) <= 900 for g in got)


def test_windows(spark):
    hits = {1, 3, 11}
    rows = [(1, i, "column" if i in hits else "other") for i in range(13)]
    got = segment.windows(spark.createDataFrame(rows, "doc_id bigint, para_idx int, para string"), Vocabulary()).orderBy("start").collect()
    assert [(g.start, g.end) for g in got] == [(0, 5), (9, 12)]


def test_mentions(spark):
    docs = spark.createDataFrame([(1, "poly(vinyl acetate)s and PEO, PEO, polymers; Polystyrene"), (2, None), (3, "PEG-MME here")], "doc_id bigint, text string")
    table = abbreviations(spark)
    assert table.count() == 84
    counts = mentions.mention_counts(mentions.mentions(docs, table))
    assert {(r.doc_id, r.name, r["count"]) for r in counts.collect()} == {(1, "polyvinyl acetate", 1), (1, "poly(ethylene oxide)", 2), (1, "polystyrene", 1), (3, "poly(ethylene glycol)", 1)}
    valid = mentions.validated(counts, table)
    assert {(r.doc_id, r.name) for r in valid.collect()} == {(1, "poly(ethylene oxide)"), (1, "polystyrene"), (3, "poly(ethylene glycol)"), (1, "polyvinyl acetate")}
    main = spark.createDataFrame([(1, "a", 65), (1, "b", 59), (1, "c", 4)], "doc_id bigint, name string, count bigint")
    assert {r.name for r in mentions.main_names(main).collect()} == {"a", "b"}


def test_responses(spark):
    answers = [
        ("fence", '```json\n{"conditions": [{"critical_unit": "p", "SP_FIELDS": [{"column_name": "c", "number_of_columns": 2}]}]}\n```'),
        ("prose", 'Sure <scratchpad>{"x": 1}</scratchpad> here: {"a": 1} and {"LCCC_conditions": [{"TECH_FIELDS": {"temperature": 6.0}}, 3]} ok'),
        ("list", '[{"behavior": {"purpose": "x"}}]'),
        ("none", "nothing"),
        ("null", None),
    ]
    df = spark.createDataFrame(answers, "id string, response string")
    flat = {(r.id, r.item_seq): r for r in response.flat(response.records(df)).collect()}
    assert set(flat) == {("fence", 0), ("prose", 0), ("list", 0)}
    assert flat["fence", 0].critical_polymer_unit == "p" and flat["fence", 0].number_of_columns == "2" and flat["fence", 0].column_name == "c"
    assert flat["prose", 0].temperature == "6"
    assert flat["list", 0].purpose == "x"
    failed = response.parse_failures(df).first()
    assert (failed.llm_calls, failed.parse_failures) == (5, 2)


def test_validation_and_catalog(spark):
    A, B = F.col("a"), F.col("b")  # noqa: N806
    checks = {"temperature": ("35 C", "35"), "purpose": ("PEO block", None), "ratio": ("60/40", "60/40"), "pore_size": ("77 A", None), "ratio_units": ("x", "x"), "solvent": ("anything", "anything")}
    for field, (value, want) in checks.items():
        assert one(spark, validate.checked(field, A, B), value, "at 60:40 v/v") == want, field
    conditions = spark.createDataFrame([(1, 1, "jordi", None), (1, 2, "zzz", None), (2, 1, "x", None)], "doc_id bigint, ord int, column_name string, phase string")
    catalog = spark.createDataFrame([(1, 0, "Other", None), (1, 1, "Jordi Gel", "rp"), (1, 2, "jordi", "np")], "doc_id bigint, col_idx int, column_name string, phase string")
    got = validate.with_catalog(conditions, catalog, ("column_name",), ("phase",)).orderBy("doc_id", "ord").collect()
    assert [(g.doc_id, g.ord, g.phase) for g in got] == [(1, 1, "rp"), (2, 1, None)]


def test_report_and_sinks(spark, tmp_path):
    rows = [(1, 1, "p", "A", None, "first goal"), (1, 2, "p", "A", "5", "second goal"), (1, 3, "p", "A", None, "goal")]
    df = records.complete_columns(spark.createDataFrame(rows, "doc_id bigint, ord int, critical_polymer_unit string, column_name string, temperature string, purpose string"))
    table = report.conditions_table(report.table_rows(df))
    got = table.first()
    assert table.count() == 1 and got.temperature == "5" and got.purpose == "first goal; second goal" and got.completeness == "complete"
    files.save_csv(table.limit(0), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*")).read_text()
    assert len(text.strip("\n").splitlines()) == 2 and text.startswith("polymer_group,")
    files.save_json(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "json"))
    assert json.loads(next((tmp_path / "json").glob("part-*")).read_text()) == {"a": 1, "b": None}


def test_markup(spark):
    xml = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><p>One <hi>two</hi></p><table><row><cell>a &amp; b</cell><cell>c</cell></row><row><cell>d</cell></row></table></body></text></TEI>'
    df = spark.createDataFrame([(1, xml), (2, "<TEI><body><p>x</p></body></TEI>")], "doc_id bigint, xml string")
    assert {r.doc_id: r.t for r in df.select("doc_id", files.tei_text(F.col("xml")).alias("t")).collect()} == {1: "One\ntwo", 2: "x"}
    assert [(r.doc_id, r.table_idx, r.row_idx, r.cells) for r in files.tei_tables(df).orderBy("row_idx").collect()] == [(1, 1, 0, ["a & b", "c"]), (1, 1, 1, ["d", ""])]


def test_text_source(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"caf\xc3\xa9 \xff ok\nline")
    assert files.text_documents(spark, str(tmp_path)).first().text == "café  ok\nline"


TEXT = """The polymers PEO and PS were separated on the columns that follow in this text.

A Nucleosil C18 column was used with acetone / water at 60/40 vol% and a temperature of 35 C for the critical conditions of PEO.

The injection volume was 20 uL and nothing else is told in this paragraph of the text."""


def test_pipeline(spark):
    docs = spark.createDataFrame([(1, TEXT), (2, None)], "doc_id bigint, text string")
    tables = pipeline.run(docs, responses.Rules(Vocabulary().solvents), pipeline.Config(refine=False))
    rows = tables["conditions_table"].collect()
    assert any(r.solvent == "Acetone / Water" and r.column_name == "Nucleosil C18" and r.ratio == "60/40" for r in rows)
    assert {r.name for r in tables["names"].collect()} == {"poly(ethylene oxide)", "polystyrene"}


class Scripted:
    """Answers like a model's, by what it is asked."""

    def responses(self, asked):
        from marlstone.plans import prompts

        begins = lambda text: F.col("prompt").startswith(text.splitlines()[0])
        column = {"column_name": "Nucleosil C18", "manufacturer": "Macherey", "pore_size": "77 A"}
        answer = (
            F.when(begins(prompts.CATALOGUE), json.dumps({"columns": [column, {"column_name": None}, 7]}))
            .when(begins(prompts.ONE_COLUMN), json.dumps({"conditions": [{"critical_polymer_unit": "PEO", "SP_FIELDS": {"column_name": "Nucleosil C18"}, "SOL_FIELDS": {"solvent": "acetone / water", "ratio": "60/40"}}]}))
            .when(begins(prompts.WHOLE), "nothing that parses")
            .when(begins(prompts.REFINE), json.dumps([{"critical_polymer_unit": "PEO", "SP_FIELDS": {"column_name": "Nucleosil C18"}, "SOL_FIELDS": {"solvent": "acetone / water", "ratio": "60/40", "ratio_units": "vol%"}, "TECH_FIELDS": {"temperature": "35 C"}}]))
            .when(begins(prompts.CLEAN), json.dumps({"conditions": [{"polymer_group": "PEO", "solvent": "tidy"}]}))
            .otherwise(json.dumps({"conditions": [{"SP_FIELDS": {"column_name": "Unknown brand"}}, {"SP_FIELDS": {"column_name": "Nucleosil"}, "SOL_FIELDS": {"solvent": "acetone / water"}, "TECH_FIELDS": {"injection_volume": "20 uL"}}]}))
        )
        return asked.withColumn("response", answer)


def test_all_passes(spark, tmp_path):
    docs = spark.createDataFrame([("a", TEXT), ("b", None), ("c", "No word of the trade in this one text at all.")], "doc_id string, text string")
    settings = pipeline.Config(models=("m",), clean=True)
    tables = pipeline.run(docs, Scripted(), settings)
    columns = tables["catalogue"].collect()
    assert [(c.doc_id, c.col_idx, c.column_name, c.manufacturer, c.pore_size) for c in columns] == [("a", 0, "Nucleosil C18", "Macherey", None)]
    got = tables["conditions"].where("doc_id = 'a'").collect()
    assert len(got) == 1 and got[0].SP_FIELDS.manufacturer == "Macherey" and got[0].TECH_FIELDS.temperature == "35" and got[0].SOL_FIELDS.ratio == "60/40"
    assert tables["conditions_raw"].where("doc_id = 'a'").first().solvent == "Acetone / Water" and tables["conditions_table"].where("doc_id = 'a'").first().solvent == "tidy"
    assert tables["clean_up"].where("doc_id = 'a'").first().used
    stats = {r.doc_id: r for r in tables["statistics"].collect()}
    assert (stats["a"].columns_catalog, stats["a"].parse_failures, stats["a"].llm_calls) == (1, 1, 3)
    capped, notes = pipeline.cleaned(tables["conditions_raw"], Scripted(), pipeline.Config(models=("m",), clean_rows=0))
    assert notes.where("doc_id = 'a'").first().reason == "row_limit" and capped.where("doc_id = 'a'").first().solvent == "Acetone / Water"
    result = pipeline.result(docs, tables)
    files.save_result(result.where("doc_id = 'a'"), str(tmp_path / "one.json"))
    told = json.loads((tmp_path / "one.json").read_text())
    assert list(told) == ["metadata", "LCCC_conditions", "tables"] and told["LCCC_conditions"][0]["SP_FIELDS"]["phase"] is None
    assert told["metadata"]["extracted_conditions"] == 1 and told["metadata"]["main_names_list"]
    files.save_result(result.where("doc_id = 'b'"), str(tmp_path / "none.json"))
    assert "tables" not in json.loads((tmp_path / "none.json").read_text())
    files.save_result(result, str(tmp_path / "many"))
    assert sum(len(p.read_text().splitlines()) for p in (tmp_path / "many").glob("part-*")) == 3
    from marlstone.plans import summary

    text = "\n".join(map(summary.plain, summary.lines(result.where("doc_id = 'a'").first(), tables["counters"].first(), 1.5)))
    assert "Conditions: 1" in text and "Acetone / Water (60/40 vol%)" in text


def test_refinement(spark):
    """An answer replaces the record, or without compat fills its nulls."""
    docs = spark.createDataFrame([("a", TEXT)], "doc_id string, text string")
    paras = segment.paragraphs(docs)
    rows = records.complete_columns(spark.createDataFrame([("a", 0, "PS", "Nucleosil C18", "50/50")], "doc_id string, ord int, critical_polymer_unit string, column_name string, ratio string")).withColumn("context_snippet", F.lit(""))
    none = spark.createDataFrame([], "doc_id string, col_idx int, " + ", ".join(f"{f} string" for f in records.STATIONARY))
    for compat, want in ((True, ("PEO", "60/40", "35")), (False, ("PS", "50/50", "35"))):
        got = pipeline.refined(rows, paras, none, Scripted(), pipeline.Config(models=("m",), compat=compat)).first()
        assert (got.critical_polymer_unit, got.ratio, got.temperature) == want


def test_services(spark, tmp_path):
    """Markup and names over HTTP, each distinct name asked for once."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from marlstone.sources import services

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            self.send_response(200 if "good" in self.path else 404)
            self.end_headers()
            self.wfile.write(b'{"IdentifierList": []}' if "good" in self.path else b"{}")

        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            self.send_response(200)
            self.end_headers()
            if self.path == "/api/generate":
                self.wfile.write(json.dumps({"response": "echo " + json.loads(body)["prompt"]}).encode())
            else:
                self.wfile.write(b"<TEI><body><p>" + str(len(body)).encode() + b"</p></body></TEI>" if b"PDFBYTES" in body and b"consolidateHeader" in body else b"")

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    try:
        pdfs = spark.createDataFrame([("x.pdf", bytearray(b"PDFBYTES")), ("y.pdf", None)], "path string, content binary")
        got = {r.path: r.xml for r in services.markup(pdfs, services.MarkupService(url=at + "/pdf")).collect()}
        assert got["x.pdf"].startswith("<TEI>") and got["y.pdf"] is None
        names = spark.createDataFrame([("Good one",), ("good one",), ("bad",), ("cached",), (None,)], "name string")
        found = pipeline.cut(services.looked_up(names, spark.createDataFrame([("cached",)], "name string"), services.NameService(url=at + "/{}")))
        assert {r.name: r.valid for r in found.collect()} == {"good one": True, "bad": False, "cached": True}
        assert sorted(asked) == ["/bad", "/good%20one"]
        prompts = spark.createDataFrame([("m", "hi")], "model string, prompt string")
        assert responses.Http(responses.Client(host=at)).responses(prompts).first().response == "echo hi"
        assert responses.Http(responses.Client(host="http://127.0.0.1:9", attempts=1)).responses(prompts).first().response is None
    finally:
        server.shutdown()


def test_command_line(spark, tmp_path, capsys):
    from marlstone import __main__ as cli

    (tmp_path / "paper.txt").write_text(TEXT)
    done = cli.main([str(tmp_path / "paper.txt"), "-o", str(tmp_path / "out.json"), "--llm-provider", "rules", "--table-csv", str(tmp_path / "csv"), "--table-xlsx", str(tmp_path / "t.xlsx")])
    assert done == 0 and "Names: 2 found" in capsys.readouterr().out
    assert json.loads((tmp_path / "out.json").read_text())["LCCC_conditions"]
    assert cli.main([str(tmp_path / "no.txt")]) == 1
    import zipfile
    from xml.etree import ElementTree

    with zipfile.ZipFile(tmp_path / "t.xlsx") as book:
        root = ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml"))
    cells = [[c.findtext(".//{*}t") or "" for c in row] for row in root.iter("{http://schemas.openxmlformats.org/spreadsheetml/2006/main}row")]
    assert tuple(cells[0]) == report.COLUMNS and any("Nucleosil C18" in row for row in cells[1:])


def test_markup_files(spark, tmp_path):
    xml = '<t:TEI xmlns:t="x"><t:body><p>a</p><t:table><t:row><t:cell>say &quot;a, b&quot;&#160;</t:cell><t:cell>c</t:cell></t:row><t:row><t:cell>d</t:cell></t:row></t:table></t:body></t:TEI>'
    docs = spark.createDataFrame([("k", xml), ("none", None)], "doc_id string, xml string")
    assert [(r.row_idx, r.cells) for r in files.tei_tables(docs).orderBy("row_idx").collect()] == [(0, ['say "a, b"', "c"]), (1, ["d", ""])]
    files.save_markup(docs, str(tmp_path / "m"))
    text, = (tmp_path / "m" / "tables" / "doc_id=k" / "table_idx=1").glob("part-*")
    assert text.read_bytes() == b'"say ""a, b""",c\r\nd,\r\n'


def test_recogniser(spark):
    docs = spark.createDataFrame([(1, "made of methyl acetate, polystyrene and water")], "doc_id bigint, text string")
    found = mentions.mentions(docs, abbreviations(spark), mentions.by_endings).where("pass = 4").orderBy("pos")
    assert [r.name for r in found.collect()] == ["methyl acetate", "polystyrene"]


def test_stream(spark, tmp_path):
    docs = spark.createDataFrame([(1, TEXT), (2, None)], "doc_id bigint, text string")
    docs.write.parquet(str(tmp_path / "in"))
    table = abbreviations(spark)
    stream = spark.readStream.schema(docs.schema).parquet(str(tmp_path / "in"))
    query = run_stream(stream, lambda batch: {"names": mentions.mention_counts(mentions.mentions(batch, table))}, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out" / "names")).count() == 2


def test_replay(spark):
    prompts = spark.createDataFrame([("m", "ask", "e")], "model string, prompt string, evidence string")
    answers = prompts.select("model", F.sha2("prompt", 256).alias("prompt_sha"), F.lit("yes").alias("response"))
    assert responses.Replay(answers).responses(prompts).first().response == "yes"


def test_evidence(spark):
    paras = spark.createDataFrame([(1, 0, "jordi with acetone"), (1, 1, "jordi and nucleosil in water"), (1, 2, "nucleosil pore size 5"), (1, 3, "temperature of it")], "doc_id bigint, para_idx int, para string")
    columns = spark.createDataFrame([(1, 0, "Jordi", None), (1, 1, "Nucleosil", None)], "doc_id bigint, col_idx int, column_name string, modification string")
    found = evidence.column_evidence(paras, columns, Vocabulary())
    assert {(r.col_idx, r.para_idx) for r in found.collect()} == {(0, 0), (1, 2)}
    text = evidence.evidence_text(found.join(paras, ["doc_id", "para_idx"]), evidence.technical_paragraphs(paras, Vocabulary()), Vocabulary())
    assert {r.col_idx: r.evidence for r in text.collect()} == {0: "jordi with acetone temperature of it", 1: "nucleosil pore size 5 temperature of it"}
    tokens = spark.createDataFrame([(1, 1, ["jordi"])], "doc_id bigint, ord int, tokens array<string>")
    assert evidence.condition_evidence(tokens, paras, Vocabulary()).first().evidence.startswith("jordi with acetone")


def test_everything_is_covered():
    fields = list(itertools.chain(records.TOP, *records.GROUPS.values()))
    assert len(set(fields)) == len(records.FIELDS) == 22


def test_conditions_table_deals_rows_out_once(spark):
    """One shuffle serves the purposes and the other columns; null ords and documents as before."""
    blank = dict.fromkeys(report.COLUMNS, "")
    told = [(1, 3, "m", "goal", ""), (1, 1, "m", "second goal", ""), (1, 2, "m", "goal", "20 C"), (1, 4, "m", "", "30 C"), (1, 5, "m", "last", "10 C"), (1, 6, "n", "", ""), (None, 1, "m", "goal", "5 C"), (2, None, "m", "goal", "5 C")]
    rows = [(d, o, *(blank | {"manufacturer": m, "purpose": p, "temperature": t}).values()) for d, o, m, p, t in told]
    df = spark.createDataFrame(rows, "doc_id bigint, ord int, " + ", ".join(f"{c} string" for c in report.COLUMNS))
    table = report.conditions_table(df)
    got = {(r.doc_id, r.manufacturer): (r.ord, r.purpose, r.temperature) for r in table.collect()}
    assert got == {(1, "m"): (1, "second goal; last", "20 C"), (1, "n"): (6, "", ""), (None, "m"): (1, "", "5 C"), (2, "m"): (None, "goal", "")}
    constant = report.conditions_table(df.withColumns({"phase": F.lit(""), "ratio_units": F.lit("")}))
    for t in (table, constant):
        assert t._jdf.queryExecution().sparkPlan().toString().count("Join") == 0
        t.collect()
        assert t._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1
