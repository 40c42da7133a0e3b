from basket_marts.llm.licenses import TEXTS, known_digests, known_licences, license_matches

SCHEMA = "doc_id bigint, text string"


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {(r.doc_id, r.license_id, r.scope, r.n_units) for r in license_matches(frame).collect()}


def test_entire_texts_in_other_dress(spark):
    mit = TEXTS["MIT"]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2020 Somebody\nAll rights reserved.\n\n" + mit.upper()),
        (3, "/*\n * " + mit.replace("\n", "\n * ") + "\n */"),
        (4, mit.replace(",", "").replace(" ", "   ")),
        (5, mit + " And one more condition."),
        (6, mit[:-5]),
        (7, TEXTS["ISC"].replace("granted", "granted").replace("fee", "fee")),
    ]
    assert found(spark, rows) == {
        (1, "MIT", "text", 1), (2, "MIT", "text", 1), (3, "MIT", "text", 1),
        (4, "MIT", "text", 1), (7, "ISC", "text", 1),
    }


def test_notices_in_lines_and_blocks(spark):
    rows = [
        (1, "Some text.\nReleased under the MIT License.\nMore text."),
        (2, "Released under\nthe MIT Licence\n\nMore text."),
        (3, "We say: Released under the MIT License."),
        (4, "licensed under apache 2.0\nLicensed under the Apache License, Version 2.0."),
        (5, "Licensed under CC BY-NC 4.0."),
    ]
    assert found(spark, rows) == {
        (1, "MIT", "part", 1), (2, "MIT", "part", 1), (4, "Apache-2.0", "part", 2),
        (5, "CC-BY-NC-4.0", "text", 1),
    }


def test_every_known_licence_finds_itself(spark):
    rows = [(i, text) for i, (_, text) in enumerate(known_licences())]
    ids = {(r[0], r[1]) for r in found(spark, rows) if r[2] == "text"}
    assert ids == {(i, name) for i, (name, _) in enumerate(known_licences())}
    assert known_digests(spark).count() <= len(rows)


def test_odd_rows(spark, odd, no_rows):
    assert license_matches(odd).collect() == []
    assert license_matches(no_rows).collect() == []
    twice = [(None, "Released under MIT"), (None, "Released under MIT"), (1, None)]
    assert found(spark, twice) == {(None, "MIT", "text", 1)}


def test_licence_files_and_texts_below_prose(spark):
    mit, apache = TEXTS["MIT"], TEXTS["Apache-2.0"]
    rows = [
        (1, f"MIT License\n\nCopyright (c) 2020 Somebody\n\n{mit}\n"),
        (2, f"A word before it.\n\nThe MIT License (MIT)\n\n{mit}\n\nAnd one after it."),
        (3, apache),
        (4, f"Some prose.\n\n{apache}"),
        (5, f"BSD 3-Clause License\n\n{TEXTS['BSD-3-Clause']}"),
        (6, f"Prose.\n\n{mit.split(chr(10) * 2, 1)[1]}"),
    ]
    assert found(spark, rows) == {
        (1, "MIT", "text", 1), (2, "MIT", "part", 1), (3, "Apache-2.0", "text", 1),
        (4, "Apache-2.0", "part", 1), (5, "BSD-3-Clause", "text", 1),
    }
