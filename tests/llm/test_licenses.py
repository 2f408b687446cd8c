import math

from tidemark.llm import licenses

from .data import frame, odd_texts, words


def brute(text, threshold=0.85):
    w = words(text)
    places = []
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    labels, met = {label for _, label in places}, {}
    for label, template in licenses.TEMPLATES:
        t, span = set(words(template)), 1
        while span < len(words(template)):
            span *= 2
        for start in range(0, len(w), span):
            both = len(t & set(w[start : start + 2 * span]))
            if both >= math.ceil(threshold * len(t) - 1e-9):
                fits = met.setdefault((start, span), {})
                fits[label] = max(fits.get(label, (0, 0)), (both / len(t), len(t)))
    blocks = sorted((*at, label, fit[0]) for at, fits in met.items() for label, fit in fits.items())
    for fits in met.values():
        labels |= {label for label, fit in fits.items() if fit == max(fits.values())}
    return len(w), sorted(places), blocks, sorted(labels)


TEXTS = [
    "x\nLicensed under the Apache License, Version 2.0\ny",
    "LICENSED under: the apache license -- version 2 0 and more words here",
    "Licensed under CC BY-NC 4.0. All rights reserved, all rights RESERVED",
    "Licensed under CC BY-SA 4.0\nLicensed under CC-BY NC 4",
    "general public license\ngeneral public\nlicense cc\nby",
    "Permission is granted free of charge to any person obtaining a copy of this software hereby",
    "released under the license\nReleased under the MIT License MIT MIT",
    "cc by cc by cc", "all rights", "É all rights reserved ß",
]


def test_equals_brute_force(spark):
    docs = frame(spark, TEXTS + odd_texts())
    rows = licenses.scan_licenses(docs).collect()
    got = sorted(
        (str(r["doc_id"]), r["n_words"], [tuple(p) for p in r["places"]],
         [(b["block"], b["span"], b["label"], b["containment"]) for b in r["blocks"]], list(r["labels"]))
        for r in rows
    )
    assert got == sorted((str(r["doc_id"]), *brute(r["text"])) for r in docs.collect())
    assert sum(bool(r["blocks"]) for r in rows) > 4
    assert licenses.scan_licenses(docs.limit(0)).collect() == []


def test_notices_over_lines_and_words_far_apart(spark):
    notice = {
        "bsd": "Redistribution and use in source and binary forms, with or without\n# modification, are permitted",
        "gpl": "This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU"
        " General\n * Public License",
        "apache-2.0": "You may obtain a copy of the License at\n\n   http://www.apache.org/licenses/LICENSE-2.0",
        "cc-by": "Licensed under CC BY 4.0",
        "cc-by-nc": "Licensed under\nCC BY-NC 4.0",
        "cc-by-sa": "licensed under CC BY-SA 4.0",
    }
    filler = [f"w{i}" for i in range(300)]
    texts, expected = [], []
    for label, text in notice.items():
        for before in (0, 1, 7, 15, 16, 31, 100):
            texts.append(" ".join([*filler[:before], text, *filler[:40]]))
            # A phrase of the contract may stand in it as well.
            expected.append({label} | {n for p, n in licenses.PHRASES if p in " ".join(words(text))})
    far = []
    for word in "Released under the MIT License".split():
        far += [word, *filler[:60]]
    texts, expected = [*texts, " ".join(far)], [*expected, set()]
    rows = licenses.scan_licenses(frame(spark, texts)).collect()
    assert {r["doc_id"]: set(r["labels"]) for r in rows} == dict(enumerate(expected))


def test_main_path_runs_no_python(spark):
    plan = licenses.scan_licenses(frame(spark, TEXTS[:2]))
    assert "Python" not in plan._jdf.queryExecution().toString()
