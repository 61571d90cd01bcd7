import textwrap

import pytest

from coursepulse.llm import licences


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark)


def found(documents, model, *texts):
    rows = licences.scan(documents(*enumerate(texts)), model).collect()
    return sorted((r.id, r.family, r.n) for r in rows)


def test_every_notice_is_its_family(documents, model):
    given = [(family, line) for family, lines in licences.NOTICES.items() if family != licences.UNKNOWN for line in lines]
    got = {i: family for i, family, _ in found(documents, model, *(f"Some prose.\n{line}\nMore prose." for _, line in given))}
    right = sum(got.get(i) == family for i, (family, _) in enumerate(given))
    assert right >= 0.95 * len(given)
    assert all(got.get(i, family) == family for i, (family, _) in enumerate(given))


def test_notices_with_changes_and_inside_a_line(documents, model):
    texts = ["RELEASED UNDER THE MIT LICENSE", "and so it ended. Licensed under the Apache License, Version 2.0. The rest is prose.",
             "This work is licenced, that is licensed under the GNU General Public License version 3"]
    assert [(i, family) for i, family, _ in found(documents, model, *texts)] == [(0, "MIT"), (1, "Apache-2.0"), (2, "GPL")]


def test_prose_is_unknown(documents, model):
    texts = [line for line in licences.NOTICES[licences.UNKNOWN] if line] + [
        "Nothing here.", "", None, " \n\n", "A licensed plumber reserved the general store.", "mit der kunst und mit dem recht",
        "domain", "word " * 100_000]
    assert found(documents, model, *texts) == []


def test_repeated_lines_and_several_notices(documents, model):
    text = "\n".join(["All rights reserved.", "x", "All rights reserved.", "Released under the MIT License."])
    assert found(documents, model, text, text) == [(i, f, n) for i in (0, 1) for f, n in (("MIT", 1), ("Proprietary", 2))]
    assert found(documents, model) == []


def test_the_level_is_calibrated(model):
    assert 0.2 < model.least < 1


WRAPPED = {
    "GPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of""",
    "LGPL": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer.""",
    "MIT": """Permission is hereby granted, free of charge, to any person
obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction""",
}


def test_wrapped_notices(documents, model):
    ways = [(mark, end) for mark in ("", " * ", "# ", "// ", "    ") for end in ("\n", "\r\n")]
    texts = ["".join(f"{mark}{line}{end}" for line in f"A file.\n\n{notice}\n\nIts code.".split("\n"))
             for mark, end in ways for notice in WRAPPED.values()]
    assert found(documents, model, *texts) == [(i, family, 1) for i, family in enumerate([*WRAPPED] * len(ways))]


def test_wrapped_at_other_widths_and_across_lines(documents, model):
    starts = [notice.split("\n\n")[0].replace("\n", " ") for notice in WRAPPED.values()]
    texts = [textwrap.fill(start, width, break_long_words=False) for width in (12, 30, 50, 100) for start in starts]
    # Parts in different paragraphs do not add up.
    texts.append("Redistribution and use in source and binary forms, with or\n\nwithout modification, are permitted provided")
    got = [(i, family) for i, family, _ in found(documents, model, *texts)]
    assert got == [*enumerate([*WRAPPED] * 4)]


def test_a_paragraph_of_many_notices(documents, model):
    assert found(documents, model, "\n".join([WRAPPED["GPL"].split("\n\n")[0]] * 200)) == [(0, "GPL", 200)]


@pytest.mark.parametrize(("text", "families"), [
    ("SPDX-License-Identifier: AGPL-3.0-only", ["AGPL"]),
    ("SPDX-License-Identifier: EPL-2.0", ["EPL-2.0"]),
    ("SPDX-License-Identifier: ISC", ["ISC"]),
    ("SPDX-License-Identifier: Zlib", ["Zlib"]),
    ("GNU Affero General Public License, version 3", ["AGPL"]),
    ("MIT License", ["MIT"]),
    ("Apache License Version 2.0, January 2004", ["Apache-2.0"]),
    ("Licensed under the ISC License.", ["ISC"]),
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", ["Apache-2.0", "MIT"]),
    ("SPDX-License-Identifier: MIT", ["MIT"]),
])
def test_named_notices(documents, model, text, families):
    assert [family for _, family, _ in found(documents, model, text)] == families


def test_unlisted_licences_are_unknown(documents, model):
    """Names that were neither learned nor used in the calibration."""
    names = ["Frobnicate", "CDDL-1.0", "Python-2.0", "Glorious Company", "OpenSSL", "LicenseRef-Internal", "Vim", "Unicode"]
    assert found(documents, model, *[line.format(name) for line in licences.UNLISTED for name in names]) == []


def test_words_are_made_once(documents, model, monkeypatch):
    """No written step holds the expression that cuts a line into words more than once."""
    plans = []
    real = licences.stage
    monkeypatch.setattr(licences, "stage", lambda df, name: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or real(df, name))
    licences.scan(documents((1, "Released under the MIT License.")), model).count()
    assert len(plans) == 5
    for plan in plans:
        assert plan.count("regexp_extract_all(lower(") <= 1
