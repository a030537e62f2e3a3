"""License scans by a positional index of rare words, with DataFrame functions only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# License notices, with their labels and the phrases that must be present.
TEMPLATES = [
    ("agpl-3.0", ["gnu affero general public license version 3"], "licensed under the gnu affero general public license version 3"),
    ("agpl-3.0", ["gnu affero general public license", "either version 3 of the license"], "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("apache-2.0", ["apache license version 2 0"], "licensed under the apache license version 2 0"),
    ("apache-2.0", ["apache license version 2 0"], "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("artistic-2.0", ["artistic license 2 0"], "released under the artistic license 2 0"),
    ("bsd", ["redistribution and use in source and binary forms"], "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-2-clause", ["provided with the distribution this software is provided by"], "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is"),
    ("bsd-3-clause", ["neither the name of", "may be used to endorse or promote products"], "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsl-1.0", ["boost software license version 1 0"], "distributed under the boost software license version 1 0"),
    ("cc-by-4.0", ["cc by 4 0"], "licensed under cc by 4 0"),
    ("cc-by-4.0", ["creative commons attribution 4 0"], "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc-4.0", ["cc by nc 4 0"], "licensed under cc by nc 4 0"),
    ("cc-by-nc-4.0", ["creative commons attribution noncommercial 4 0"], "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa-4.0", ["cc by sa 4 0"], "licensed under cc by sa 4 0"),
    ("cc-by-sa-4.0", ["creative commons attribution sharealike 4 0"], "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0-1.0", ["creative commons zero"], "released under the creative commons zero 1 0 universal license"),
    ("epl-2.0", ["eclipse public license 2 0"], "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("epl-2.0", ["eclipse public license v 2 0"], "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0"),
    ("gpl-2.0", ["gnu general public license", "either version 2 of the license"], "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-2.0", ["gnu general public license version 2"], "licensed under the gnu general public license version 2"),
    ("gpl-3.0", ["gnu general public license version 3"], "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", ["gnu general public license", "either version 3 of the license"], "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("isc", ["permission to use copy modify and or distribute this software"], "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl-2.1", ["gnu lesser general public license", "either version 2 1 of the license"], "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("lgpl-3.0", ["gnu lesser general public license", "either version 3 of the license"], "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("lgpl-3.0", ["gnu lesser general public license version 3"], "licensed under the gnu lesser general public license version 3"),
    ("mit", ["mit license"], "released under the mit license"),
    ("mit", ["permission is hereby granted free of charge"], "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2.0", ["mozilla public license v 2 0"], "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", ["free and unencumbered software"], "this is free and unencumbered software released into the public domain"),
    ("zlib", ["permission is granted to anyone to use this software for any purpose"], "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("eupl-1.2", ["european union public licence"], "licensed under the eupl version 1 2 european union public licence"),
    ("wtfpl", ["do what the fuck you want to public license"], "do what the fuck you want to public license"),
    ("0bsd", ["zero clause bsd"], "released under the zero clause bsd license"),
    ("cc-by-nd-4.0", ["creative commons attribution noderivatives 4 0"], "this work is licensed under a creative commons attribution noderivatives 4 0 international license"),
    ("cc-by-nc-sa-4.0", ["creative commons attribution noncommercial sharealike 4 0"], "this work is licensed under a creative commons attribution noncommercial sharealike 4 0 international license"),
]

# Identifiers of SPDX lines, with their labels.
SPDX = {
    "Apache-2.0": "apache-2.0", "MIT": "mit", "ISC": "isc", "Zlib": "zlib", "MPL-2.0": "mpl-2.0", "0BSD": "0bsd", "Unlicense": "unlicense", "BSL-1.0": "bsl-1.0", "EPL-2.0": "epl-2.0", "EUPL-1.2": "eupl-1.2",
    "BSD-2-Clause": "bsd-2-clause", "BSD-3-Clause": "bsd-3-clause", "GPL-2.0": "gpl-2.0", "GPL-3.0": "gpl-3.0", "LGPL-2.1": "lgpl-2.1", "LGPL-3.0": "lgpl-3.0", "AGPL-3.0": "agpl-3.0", "CC0-1.0": "cc0-1.0", "CC-BY-4.0": "cc-by-4.0",
}
for _identifier, _label in SPDX.items():
    _line = " ".join(re.findall("[a-z0-9]+", f"spdx license identifier {_identifier}".lower()))
    TEMPLATES.append((_label, [_line], _line))


@dataclass(frozen=True)
class LicenseScan:
    """Parameters. A template is found where `least_share` of its words' weight, ln(documents /
    documents with the word), stands at one relative position."""

    least_share: float = 0.6


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def folded_words(text: Column) -> Column:
    """The words of a text, runs of what WORD names with A-Z, and only these, in lower case; none for a null.

    Characters between words become spaces and texts are split at these, which is several
    times as fast as matching the words."""
    spaced = F.translate(F.coalesce(text, F.lit("")), _CAPITALS + _BETWEEN, _CAPITALS.lower() + " " * len(_BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def _stands(words: Column, at: Column, phrase: list[str], pivot: int) -> Column:
    """Whether the phrase stands with its pivot word at this position."""
    tests = [F.get(words, at + (i - pivot)) == w for i, w in enumerate(phrase) if i != pivot]
    out = F.lit(True)
    for t in tests:
        out = out & F.coalesce(t, F.lit(False))
    return out


def scan_licenses(docs: DataFrame, p: LicenseScan = LicenseScan(), text_col: str = "text") -> DataFrame:
    """`docs` with n_words, n_base, first_word, last_word, base_labels, labels and score, which replace columns of these names.

    First pass: how many documents have each word of the templates, a count as long as the
    templates' vocabulary. Second pass, a row at a time and without moving anything: the
    places of phrase words and of each template's rarest words, however common these are.
    Postings turn such a place into a place where a template would begin, if all the key
    phrases of the template are in the file. There all words of the template are compared;
    it counts if those that stand in their places weigh enough, and if each key phrase stands
    within that place, and not elsewhere in the file. A template's postings are
    as many of its rarest words as leave less than `least_share` to the others, so that no
    begin with enough weight is missed. The best share of the weight is the score; a file
    with a base phrase scores at least 0.5.

    A null or empty text has no words and no labels. Equal rows each get their row; no rows
    give none."""
    added = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    inner = ("__words", "__hits", "__keys", "__where", "__able", "__base", "__found")
    docs = without(docs, *added, *inner)
    vocabulary = sorted({w for _, _, t in TEMPLATES for w in t.split()})
    words = docs.select(folded_words(F.col(text_col)).alias("words"))
    present = words.select(F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary))).alias("found"))
    counted = present.select(F.explode_outer(F.concat("found", F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    df = {r.w: r.n for r in counted}
    n_docs = df.pop("", 0)
    idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 0.5)) for w in vocabulary}
    postings = _postings(idf, p)

    keys = sorted({k for _, ks, _ in TEMPLATES for k in ks})
    pivots = {k: max(range(len(k.split())), key=lambda i, k=k: (idf.get(k.split()[i], 99.0), -i)) for k in [*keys, *PHRASES]}
    looked = sorted(postings.keys() | {k.split()[i] for k, i in pivots.items()})
    table = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text_col], folded_words(F.col(text_col)).alias("__words"))
    hits = F.filter(F.transform("__words", lambda w, i: F.named_struct(F.lit("w"), w, F.lit("at"), i)), lambda h: h["w"].isin(looked))

    def places(phrase: str) -> Column:
        ws, i = phrase.split(), pivots[phrase]
        return F.transform(F.filter("__hits", lambda h: (h["w"] == ws[i]) & _stands(F.col("__words"), h["at"], ws, i)), lambda h: h["at"] - i)

    def labelled_places(phrase: str, label: str) -> Column:
        return F.transform(places(phrase), lambda at: F.named_struct(F.lit("at"), at.cast("long"), F.lit("label"), F.lit(label)))

    base = F.concat(*[labelled_places(k, v) for k, v in PHRASES.items()])
    def key_places_of(i: int, phrase: str) -> Column:
        return F.transform(places(phrase), lambda at: F.named_struct(F.lit("key"), F.lit(i), F.lit("at"), at.cast("int")))

    key_places = F.concat(*[key_places_of(i, k) for i, k in enumerate(keys)])
    needed = F.array(*[F.struct(F.lit(t).alias("template"), F.array(*[F.lit(keys.index(k)) for k in needs]).alias("needs")) for t, (_, needs, _) in enumerate(TEMPLATES)])
    able = F.transform(F.filter(needed, lambda t: F.size(F.array_except(t["needs"], F.col("__keys"))) == 0), lambda t: t["template"])
    table = table.withColumn("__hits", hits).withColumn("__base", base).withColumn("__where", key_places)
    table = table.withColumn("__keys", F.array_distinct(F.transform("__where", lambda k: k["key"]))).withColumn("__able", able).drop("__keys")
    table = table.withColumn("__found", _found(idf, postings, keys, p)).withColumn("n_words", F.size("__words").cast("long"))
    base_labels = F.array_sort(F.array_distinct(F.transform("__base", lambda b: b["label"])))
    own = F.transform("__found", lambda t: t["label"])
    share = F.array_max(F.transform("__found", lambda t: t["share"]))
    out = (
        table.withColumn("n_base", F.size("__base").cast("long"))
        .withColumn("first_word", F.array_min(F.transform("__base", lambda b: b["at"])))
        .withColumn("last_word", F.array_max(F.transform("__base", lambda b: b["at"])))
        .withColumn("base_labels", F.array_join(base_labels, ","))
        .withColumn("labels", F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, own))), ","))
        .withColumn("score", F.least(F.lit(1.0), F.greatest(F.coalesce(share, F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))))
    )
    kept = [c for c in table.columns if c not in (*inner, "n_words")]
    return out.select(*[F.col(f"`{c}`") for c in kept], *added)


def _postings(idf: dict[str, float], p: LicenseScan) -> dict[str, list[tuple[int, int]]]:
    """By word, the (template, place in it) by which it looks templates up."""
    out: dict[str, list[tuple[int, int]]] = {}
    for t, (_, _, text) in enumerate(TEMPLATES):
        ws = text.split()
        total = rest = sum(idf[w] for w in ws)
        for w in sorted(set(ws), key=lambda w: (-idf[w], w)):
            if rest < (p.least_share - 1e-9) * total:
                break
            out.setdefault(w, []).extend((t, i) for i, x in enumerate(ws) if x == w)
            rest -= idf[w] * ws.count(w)
    return out


def _found(idf: dict[str, float], postings: dict[str, list[tuple[int, int]]], keys: list[str], p: LicenseScan) -> Column:
    """The (label, share of the weight) of every place of __words where a template is found with its key phrases in it."""
    row = lambda **x: F.struct(*[F.lit(v).alias(k) for k, v in x.items()])
    index = F.create_map(*[x for w, at in sorted(postings.items()) for x in (F.lit(w), F.array(*[row(template=t, at=i) for t, i in at]))])
    notices = F.array(*[
        F.struct(F.lit(label).alias("label"), F.array(*[F.lit(keys.index(k)) for k in needs]).alias("needs"), F.lit(float(sum(idf[w] for w in text.split()))).alias("total"), F.array(*[row(w=w, at=i, weight=float(idf[w])) for i, w in enumerate(text.split())]).alias("words"))
        for label, needs, text in TEMPLATES
    ])
    # a begin is one number, place * 256 + template, so that equal ones are found by hashing
    looking = F.filter("__hits", lambda h: h["w"].isin(sorted(postings)))
    begins = F.flatten(F.transform(looking, lambda h: F.transform(F.filter(F.element_at(index, h["w"]), lambda q: F.array_contains("__able", q["template"])), lambda q: (h["at"] - q["at"]).cast("long") * 256 + q["template"])))

    def measured(begin: Column) -> Column:
        notice, first = F.element_at(notices, (F.pmod(begin, F.lit(256)) + 1).cast("int")), F.shiftright(begin, 8).cast("int")
        stands = F.aggregate(notice["words"], F.lit(0.0), lambda sum_, w: sum_ + F.when(F.get(F.col("__words"), first + w["at"]) == w["w"], w["weight"]).otherwise(F.lit(0.0)))
        inside = lambda k: (k["at"] >= first) & (k["at"] < first + F.size(notice["words"]))
        missing = F.size(F.array_except(notice["needs"], F.transform(F.filter("__where", inside), lambda k: k["key"])))
        return F.struct(notice["label"].alias("label"), (stands / notice["total"]).alias("share"), missing.alias("missing"))

    enough = F.filter(F.transform(F.array_distinct(begins), measured), lambda t: (t["share"] >= p.least_share) & (t["missing"] == 0))
    found = F.transform(enough, lambda t: F.struct(t["label"].alias("label"), t["share"].alias("share")))
    return F.when(F.size("__able") > 0, found).otherwise(F.array().cast("array<struct<label:string,share:double>>"))


def words_of(text: str | None) -> list[str]:
    """The same words, for one text on the driver."""
    return re.findall(WORD, (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
