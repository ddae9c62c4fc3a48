from __future__ import annotations

from dataclasses import replace

from muster.operators import exports, scan


def test_contract():
    assert exports.contract_faults(exports.EXPORTS) == [] and len(exports.EXPORTS) == 12
    e = exports.EXPORTS["dim_public_organizations"]
    assert e.measures == () and exports.EXPORTS["mart_spell_censoring_summary"].measures == ("spell_count",)
    assert len(exports.contract_faults({"a": replace(e, named=False), "b": replace(e, grain=("x",))})) == 6


def counted(spark, text):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    return {r.category: r.finding_count for r in scan.findings(df, "id", "text", ("ok.example.org/check",)).collect()}


def test_detectors(spark):
    assert counted(spark, None) == {} and counted(spark, "plain text, 12 34") == {}
    assert counted(spark, "12-3456789 and 112-3456789") == {"federal_id": 1}
    assert counted(spark, "FEIN:\n123456789, " + "x " * 15 + "987654321 and later " + "y " * 30 + "111111111") == {"labelled_id": 1}
    assert counted(spark, "federal tax  id number 123456789; EIN" + " " * 36 + "123456789; EIN" + " " * 38 + "123456789") == {"labelled_id": 2}
    assert counted(spark, "12 Main street, 4 N. Oak\nAVE and 77 Way") == {"street_address": 2}
    assert counted(spark, "12 of records the same way") == {}
    assert counted(spark, "Mailing: 12 of records the same way. And 12 of records the same way, here") == {"street_address": 2}
    assert counted(spark, "415-555-0100 a.b@c.org C:\\dir\\file /home/x/y z/home/x") == {"phone": 1, "email": 1, "windows_path": 1, "home_path": 1}
    assert counted(spark, "http://a.b/c?x=1&EIN=2 https://ok.example.org/check?ein=3 http://a.b/ein=4") == {"join_url": 1}


def test_letters_and_spaces_beside_ascii(spark):
    """As engines read the patterns whose word ends are those of ASCII."""
    assert counted(spark, "12 Main stä, ä12 Main St, 12 Main Stx") == {"street_address": 2}
    assert counted(spark, "12 Main \u017ft, 12 Par\u212a Way, 12 M\u0131n Way, 12\x0bMain St") == {"street_address": 2}
    assert counted(spark, "ä415-555-0100ö ü12-3456789 öa@b.org EIN 123456789ß") == {"phone": 1, "federal_id": 1, "email": 1, "labelled_id": 1}
    assert counted(spark, "EIN" + "\U0001f600" * 36 + " 123456789; EIN" + "\U0001f600" * 37 + " 123456789") == {"labelled_id": 1}
    assert counted(spark, "EIN 111111111 222222222 333333333 444444444 555555555 666666666") == {"labelled_id": 4}
    assert counted(spark, "mailing " + "12" + " " * 5000 + "of records the same way") == {"street_address": 1}


def test_allowed_links_and_decoded_keys(spark):
    assert counted(spark, "https://OK.example.org/CHECK/more?ein=1 https://ok.example.org/checked?SSN=1") == {}
    assert counted(spark, "https://ok.example.org/chec?ein=1 https://ok.example.org.evil.com/check?ein=1 https://ok.example.org@evil.com/check?ein=1") == {"join_url": 3, "email": 1}
    assert counted(spark, "https://me:pw@ok.example.org:8080/check?ein=1 http://a.b/c?e%69n=4 http://a.b/c?x=1&SSN http://a.b/c#?ein=1 http://a.b/c?x=ein http://a.b/?e%zzn=1") == {"join_url": 2, "email": 1}


def test_findings_over_line_ends(spark):
    """Every detector's lines against a plain scan by offsets."""
    text = "a 12 Main\nStreet, 12 of records the same\nway and\nEIN\n123456789 http://a.b/?ein=1\n\n987654321 http://ok.example.org/check?ein=2 12-3456789\u0001 12-3456789\n4 N.\nOak\n\nAve\n/home/x"
    df = spark.createDataFrame([(1, text), (2, None), (3, "x" * 50_000 + "\n" * 2000 + "a@b.org " * 3000)], "id long, text string")
    got = sorted((r.row_id, r.category, r.line_no, r.finding_count) for r in scan.located(df, "id", "text", ("ok.example.org/check",)).collect())
    line = lambda part: text[: text.index(part)].count("\n") + 1
    assert got == sorted([
        (1, "street_address", line("12 Main"), 1), (1, "street_address", line("4 N."), 1), (1, "street_address", line("12 of"), 1), (1, "labelled_id", line("123456789"), 1), (1, "labelled_id", line("987654321"), 1), (1, "join_url", line("http://a.b"), 1),
        (1, "federal_id", line("12-3456789"), 2), (1, "home_path", line("/home/x"), 1), (3, "email", 2001, 3000),
    ])


def test_lines_of_findings_beside_other_letters(spark):
    df = spark.createDataFrame([(1, "ä\n12 Main stä\n\x0b12 Main\nStö EIN\n123456789")], "id long, text string")
    assert sorted((r.category, r.line_no) for r in scan.located(df, "id", "text").collect()) == [("labelled_id", 5), ("street_address", 2), ("street_address", 3)]


def test_lines_of_findings(spark):
    df = spark.createDataFrame([(1, "a\n12-3456789\n\nb@c.org 12-3456789"), (2, None)], "id long, text string")
    assert sorted((r.category, r.line_no, r.finding_count) for r in scan.located(df, "id", "text").collect()) == [("email", 4, 1), ("federal_id", 2, 1), ("federal_id", 4, 1)]
