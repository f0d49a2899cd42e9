import hashlib
import re

from loadledger.llm import QUERIES
from loadledger.llm.secrets import RULES, Rule, findings_by_path, scan_history
from loadledger.work import new_dir

KEY = "AKIA" + "Z9" * 8
ROWS = [
    (1, None),
    (2, ""),
    (3, "é password: token: abcdefghijklmnopqr"),
    (4, f"x{KEY}AKIA {KEY} AKIAAKIA{'B' * 14} AKIAB"),
    (5, "deadbeef" * 3 + "g" + "0" * 15 + "G" + "0" * 16),
    (6, "API_KEY = 'abcdefghijkl' apikey=short tOkEn=\"" + "q" * 400 + "\" 日本 secret:=x=yyyyyyyyyyyyyy"),
    (7, "é password: token: abcdefghijklmnopqr"),
    (8, ("word " * 30_000) + "passwd=" + "0123456789abcdef" * 4),
    (9, "".join(f"token={'a' * (i % 30)} " for i in range(3_000))),
    (10, "passwordpassword=aaaaaaaaaaaaaaaa"),
]


def spans_of(text):
    base = {
        "assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                   lambda m: len(m[2]) >= 12),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
    }
    found = []
    for order, (kind, (pattern, counts)) in enumerate(base.items()):
        flags = re.I | re.A if kind == "assign" else 0
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}")
                  for m in re.finditer(pattern, text or "", flags) if counts(m)]
    return [span for _, _, span in sorted(found)]


def test_agrees_with_brute_force_and_sql(spark, tables, agrees):
    folder = tables(documents=(ROWS, "doc_id long, text string"))
    result = QUERIES["op1_secret_scan"](spark, folder)
    got = {r.doc_id: r for r in result.collect()}
    assert set(got) == {i for i, _ in ROWS}
    for doc_id, text in ROWS:
        spans = spans_of(text)
        row = got[doc_id]
        assert row.spans == ",".join(spans)
        assert row.base_sha256 == hashlib.sha256(row.spans.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [
            sum(s.startswith(kind) for s in spans) for kind in ("assign", "access", "hex")]
    agrees("op1_secret_scan", result, folder)


def test_agrees_with_sql_on_given_tables(spark, sf_dir, agrees):
    agrees("op1_secret_scan", QUERIES["op1_secret_scan"](spark, sf_dir), sf_dir)


def test_only_unseen_pairs_are_scanned(spark):
    shape = "path string, text string, blob string, kind int"
    ledger = new_dir(spark, "ledger")
    first = spark.createDataFrame([("a", KEY, "b", 1), (None, KEY, "b", 1), ("c", "0" * 16, "b", 1)], shape)
    addressed, findings = scan_history(first, ledger)
    assert sorted(map(tuple, findings_by_path(addressed, findings).select("path", "kind", "start", "end").collect()),
                  key=repr) == sorted([("a", "access", 0, 20), (None, "access", 0, 20), ("c", "hex", 0, 16)], key=repr)
    scanned = spark.read.parquet(f"{ledger}/scanned")
    assert scanned.count() == 6
    later = spark.createDataFrame([("a", KEY, "b", 1), ("d", KEY, "b", 1), ("c", "new " + KEY, "b", 1)], shape)
    addressed, findings = scan_history(later, ledger)
    assert spark.read.parquet(f"{ledger}/scanned").count() == 9
    assert {tuple(r) for r in findings_by_path(addressed, findings).select("path", "start").collect()} == {
        ("a", 0), ("d", 0), ("c", 4)}
    rules = [RULES[0], Rule("access", "AKIA[A-Z0-9]{10,}", least=14, version=2), RULES[2]]
    addressed, findings = scan_history(later, ledger, rules)
    assert spark.read.parquet(f"{ledger}/scanned").count() == 11
    assert {(r.path, r.version) for r in findings_by_path(addressed, findings).collect()} == {
        ("a", 2), ("d", 2), ("c", 2)}


def test_empty_table_and_repeated_rows(spark, tables):
    empty = tables(documents=([], "doc_id long, text string, spans string"))
    assert QUERIES["op1_secret_scan"](spark, empty).collect() == []
    docs = spark.createDataFrame([("a", KEY), ("a", KEY), ("a", None)], "path string, text string")
    addressed, findings = scan_history(docs, new_dir(spark, "ledger"))
    assert findings_by_path(addressed, findings).count() == 2
