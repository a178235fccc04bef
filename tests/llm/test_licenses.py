"""Licence scan next to a plain version with dictionaries."""

import math
import re
import textwrap
from collections import Counter

import regex

from pulsegrid.llm import licenses
from pulsegrid.llm.queries import QUERIES

FILES = "path string, text string, license string, score int"


def terms(text):
    return Counter(regex.findall(r"[\p{L}\p{N}]+(?:\.[0-9]+)*", text.lower()))


def plain(files, known, is_file):
    """(path, license, origin, licensed_by) of every file."""
    def notices(path, text):
        every = re.split(r"\r?\n", text)
        cues = [k for k, x in enumerate(every) if re.search(licenses.CUES, x, re.I)]
        near = {k for c in cues for k in range(c - licenses.AROUND, c + licenses.AROUND + 1)}
        blocks = [[]]
        for k, x in enumerate(every):
            if k in near and regex.search(r"[\p{L}\p{N}]", x):
                blocks[-1].append((k, x))
            else:
                blocks.append([])
        some = {"\n".join(x for _, x in b) for b in blocks if any(k in cues for k, _ in b)}
        return some | {every[k] for k in cues} | ({text} if is_file(path, text) else set())
    found = [notices(p, t) if t is not None else set() for p, t in files]
    held, total = Counter(), len(known)
    for some in found:
        for n in some:
            held.update(set(terms(n)))
            total += 1
    for _, t in known:
        held.update(set(terms(t)))
    vector = lambda t: {k: n * (math.log((1 + total) / (1 + held[k])) + 1) for k, n in terms(t).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0
    vectors = [(name, vector(t), sum(terms(t).values()) < licenses.FULL_TERMS) for name, t in known]
    cache = {}

    def best(notice):
        if notice not in cache:
            v = vector(notice)
            scored = [(short, -round(sum(x * w.get(k, 0) for k, x in v.items()) / length(v) / length(w), 6), name) for name, w, short in vectors]
            cache[notice] = min((s for s in scored if -s[1] >= (licenses.LEAST if s[0] else licenses.FULL)), default=None)
        return cache[notice]
    own = [min((b for n in some if (b := best(n))), default=None) for some in found]
    stated = {}
    for (p, t), b in zip(files, own):
        if b and p is not None and is_file(p, t):
            d = p.rpartition("/")[0]
            stated[d] = min(stated.get(d, (b[1], p, b[2])), (b[1], p, b[2]))
    out = []
    for (p, _), b in zip(files, own):
        if b:
            out.append((p, b[2], "own", p))
            continue
        d, hit = (p or "").rpartition("/")[0], None
        while p is not None and hit is None:
            hit = stated.get(d)
            if not d:
                break
            d = d.rpartition("/")[0]
        out.append((p, hit[2], "inherited", hit[1]) if hit else (p, None, None, None))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.path, r.license, r.origin, r.licensed_by) for r in frame.collect()), key=str)


APACHE, MIT = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."


def test_scan(spark):
    files = [("LICENSE", "All rights reserved."), ("a/COPYING", f"{MIT}\n"), ("a/LICENSE.txt", "nothing at all"), ("a/b/c/x.py", "code"), ("a/y.py", f"text\n# {APACHE}\nmore"),
             ("b/x.py", None), ("b/z.py", ""), ("b/license plates.md", "a license to drive a car is not this"), (None, "code"), (None, APACHE), ("top.py", "code"),
             ("a/b/LICENSE", APACHE), ("a/b/LICENSE2", MIT), ("a/b/c/x.py", "code"), ("ab/x.py", "code"), ("b/long.py", "words " * 50_000 + "license"),
             ("c/LICENSE", None), ("c/d/w.py", f"{APACHE}\n{MIT}"), ("/abs/LICENSE", MIT), ("/abs/q/r.py", "x")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in files], FILES)
    is_file = lambda p, t: bool(p and re.search(licenses.LICENSE_FILE, p))
    out = got(licenses.scan(frame, licenses.templates(spark)))
    assert out == plain(files, licenses.TEMPLATES, is_file)
    by = {r[0]: r[1:] for r in out if r[0]}
    assert by["a/b/c/x.py"] == ("Apache-2.0", "inherited", "a/b/LICENSE") and by["ab/x.py"][0] == "proprietary" and by["a/y.py"][1] == "own"
    assert licenses.scan(frame.limit(0), licenses.templates(spark)).count() == 0
    none = licenses.scan(frame, licenses.templates(spark).limit(0))
    assert none.count() == len(files) and none.filter("license IS NOT NULL").count() == 0


def test_templates_find_themselves(spark):
    frame = spark.createDataFrame([(f"{i}/LICENSE", t) for i, (_, t) in enumerate(licenses.TEMPLATES)], "path string, text string")
    names = {r.path: r.license for r in licenses.scan(frame, licenses.templates(spark)).collect()}
    assert names == {f"{i}/LICENSE": name for i, (name, _) in enumerate(licenses.TEMPLATES)}


def wrapped(text, width=72, before=" * "):
    return "\n".join(before + x for x in textwrap.wrap(text, width))


def test_wrapped_headers(spark):
    """The header as a whole tells which licence it is; its lines alone may name another."""
    rest = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
            " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.")
    kinds = {
        "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as"
                    " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published"
                   " by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published"
                   " by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as"
                    " published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    }
    files = [(f"{i}/{name}/{width}.c", f"/*\n * Copyright 2020 A. Body\n *\n{wrapped(text, width)}\n *\n{wrapped(rest, width)}\n */{end}int main() {{ return 0; }}{end}")
             for i, end in enumerate(("\n", "\r\n")) for name, text in kinds.items() for width in (50, 72, 100)]
    frame = spark.createDataFrame(files, "path string, text string")
    out = got(licenses.scan(frame, licenses.templates(spark)))
    assert out == plain(files, licenses.TEMPLATES, lambda p, t: False)
    assert all(license == path.split("/")[1] for path, license, _, _ in out)


def test_licence_files(spark):
    """Whole files of short licences, wrapped and with a copyright line; of long ones their title says which."""
    whole = [(name, t) for name, t in licenses.TEMPLATES if sum(terms(t).values()) >= licenses.FULL_TERMS]
    assert {"MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "Unlicense"} == {name for name, _ in whole}
    files = [(f"{name}/LICENSE", f"Copyright (c) 2020 A. Body\n\n{wrapped(t, 78, '')}\n") for name, t in whole]
    body = "\n\n".join(wrapped(f"{k}. You may convey a covered work under the terms of this License, provided that you also meet all of these conditions.", 70, "")
                       for k in range(200))
    files += [("GPL-3.0/COPYING", f"                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n{body}"),
              ("AGPL-3.0/COPYING", f"                    GNU AFFERO GENERAL PUBLIC LICENSE\n                       Version 3, 19 November 2007\n\n{body}"),
              ("LGPL-2.1/COPYING", f"                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n\n{body}")]
    files += [(f"{p.split('/')[0]}/src/deep/x.c", "int x;") for p, _ in files]
    frame = spark.createDataFrame(files, "path string, text string")
    out = got(licenses.scan(frame, licenses.templates(spark)))
    assert out == plain(files, licenses.TEMPLATES, lambda p, t: bool(re.search(licenses.LICENSE_FILE, p)))
    assert all(license == path.split("/")[0] for path, license, _, _ in out)


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect()]
    files = [(f"{s}/{k // 1000}/{k}.txt", t) for k, t, s in docs]
    opens = lambda p, t: any(re.search(licenses.CUES, line, re.I) for line in (t or "").split("\n")[::max(1, (t or "").count("\n"))])
    rows = QUERIES["op10_licenses"](spark, sf_dir)
    assert got(rows) == plain(files, licenses.TEMPLATES, opens)
    assert sorted(r.doc_id for r in rows.collect()) == sorted(k for k, _, _ in docs)
