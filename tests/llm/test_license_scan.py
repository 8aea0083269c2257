"""Notices of the synthetic documents, held-out wordings and look-alikes."""

from __future__ import annotations

import re

import pytest

from plumbline.llm import license_scan

FOLDER = "/root/testdata/sf0.01"
LINES = {
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
}
OTHERS = {
    "This code is released under the MIT license": "MIT",
    "// Licensed under the Apache License Version 2.0 (the License);": "Apache-2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted": "BSD",
    "This file is licensed under CC BY-SA 4.0 by its author": "CC-BY-SA",
    "All rights reserved. Copyright 2020 by nobody.": "unknown",
    "The fisherman lost his licence and asked for permission to fish": "unknown",
    "Licensed under the Foo Bar License, version 3.": "unknown",
    "Public domain is a term of law.": "unknown",
}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def model(docs):
    return license_scan.fit(docs)


def test_notices_of_the_corpus(docs, model):
    want = {(r["doc_id"], i): LINES[line] for r in docs.collect() for i, line in enumerate(r["text"].split("\n")) if line in LINES}
    got = {(r["doc_id"], r["paragraph"]): r["family"] for r in license_scan.scan(docs, model).collect()}
    assert len(want) > 10 and got == want


def test_other_wordings_and_look_alikes(spark, model):
    rows = [(i, f"first line\n{line}\nlast line {'x' * 10}", i) for i, line in enumerate(OTHERS)] + [(None, None, 0), (70, "", 0), (71, "Released under the MIT License.\n" * 500 + "word " * 100_000, 0), (None, "MIT License.\nSPDX-License-Identifier: MIT", 0)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, line int"), model).collect()
    got = {(r["doc_id"], r["paragraph"]): r["family"] for r in found}
    for i, (line, family) in enumerate(OTHERS.items()):
        assert got[i, 1] == family, line
    assert sum(r["doc_id"] == 71 and r["family"] == "MIT" for r in found) == 500
    assert got[None, 1] == "MIT" and (70, 0) not in got


WRAPPED = {
    """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""": ["GPL-3.0"],
    """ * This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version.""": ["GPL-2.0"],
    """// This library is free software; you can redistribute it and/or
// modify it under the terms of the GNU Lesser General Public
// License as published by the Free Software Foundation; either
// version 2.1 of the License, or (at your option) any later version.""": ["LGPL"],
    """Permission is hereby granted, free of charge, to any person obtaining a
copy of this software and associated documentation files (the "Software"),
to deal in the Software without restriction, including without limitation""": ["MIT"],
    """Redistribution and use in source and binary
forms, with or without modification, are
permitted provided that the following
conditions are met:""": ["BSD"],
    "Released under\nthe MIT\nLicense. Or\nlicensed under the\nApache License,\nVersion 2.0.": ["Apache-2.0", "MIT"],
    "Released under the MIT License. Licensed under the Apache License, Version 2.0.": ["Apache-2.0", "MIT"],
    "This work is released into the public\n * domain under CC0 1.0.": ["public domain"],
    "The license of the program\nis free for you: the permission\nto use it is of the version 3": [],
}


def test_notices_over_several_lines_and_two_licences(spark, model):
    rows = [(i, f"some words before\n\n{text}\n\n{'and words after ' * 40}") for i, text in enumerate(WRAPPED)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    for i, (text, families) in enumerate(WRAPPED.items()):
        assert sorted(r["family"] for r in found if r["doc_id"] == i and r["family"] != "unknown") == families, text
    assert [r["family"] for r in found if r["doc_id"] == 0 and r["paragraph"] < 5] == ["GPL-3.0"]  # its lines give no rows of their own


def test_main_path_is_native_and_empty_table(docs, model):
    plan = license_scan.scan(docs, model)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert license_scan.scan(docs.limit(0), model).collect() == []
