"""License scans by sentence rules.

Sentences are normalised (case, marks, spelling, "this work is", the verb of the grant) and
looked up among known licence sentences; what remains of a text is the ordered list of the
identifiers found. A rule is an ordered list of identifiers; it matches where they follow
one another with at most ``GAP`` other sentences in between. Texts are read twice: with line
ends as sentence ends, and with lines joined, for sentences that are wrapped.

Null, empty and other texts give no row; repeated rows give one; an empty table gives none;
other columns are not read. A licence named several times gives one row per rule, with the
place of its first match (sentence number, from 0, in the reading that found it first). Where one rule
begins with all of another, and both match from the same sentence, only the longer one counts. A grant or
an SPDX expression of several licences ("MIT OR Apache-2.0") names each of them.
"""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP = 3

# Names of licences, by SPDX identifier.
NAMES = {
    "MIT": ["mit license", "mit"],
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0", "apache-2.0", "apache 2.0 license"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl v3", "gplv3", "gpl-3.0", "gnu gplv3"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl v2", "gplv2", "gpl-2.0", "gnu gplv2"],
    "LGPL-3.0": ["gnu lesser general public license version 3", "gnu lesser general public license v3", "lgplv3", "lgpl-3.0"],
    "LGPL-2.1": ["gnu lesser general public license version 2.1", "lgplv2.1", "lgpl-2.1"],
    "AGPL-3.0": ["gnu affero general public license version 3", "agplv3", "agpl-3.0"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mpl 2.0", "mpl-2.0"],
    "BSD-3-Clause": ["bsd 3-clause license", "3-clause bsd license", "new bsd license", "bsd-3-clause"],
    "BSD-2-Clause": ["bsd 2-clause license", "2-clause bsd license", "simplified bsd license", "bsd-2-clause"],
    "ISC": ["isc license", "isc"],
    "Unlicense": ["unlicense"],
    "CC0-1.0": ["cc0", "cc0 1.0", "cc0-1.0", "creative commons zero"],
    "CC-BY-4.0": ["cc by 4.0", "cc-by-4.0", "creative commons attribution 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by-sa 4.0", "cc-by-sa-4.0", "creative commons attribution-sharealike 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by-nc 4.0", "cc-by-nc-4.0", "creative commons attribution-noncommercial 4.0 international license"],
    "CC-BY-ND-4.0": ["cc by-nd 4.0", "cc-by-nd-4.0", "creative commons attribution-noderivatives 4.0 international license"],
}

# Sentences of licence texts and headers, normalised.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www.apache.org licenses license-2.0",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl-header": "this source code form is subject to the terms of the mozilla public license v. 2.0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "all-rights": "all rights reserved",
}

# (rule, licence, ordered sentences)
TEXT_RULES = [
    ("mit-text", "MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("isc-text", "ISC", ["isc-grant", "isc-warranty"]),
    ("bsd3-text", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("bsd2-text", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("apache-header", "Apache-2.0", ["apache-use", "apache-copy", "apache-basis"]),
    ("gpl3-header", "GPL-3.0-or-later", ["gpl-free", "gpl-warranty"]),
    ("gpl2-header", "GPL-2.0-or-later", ["gpl2-free", "gpl-warranty"]),
    ("mpl-header", "MPL-2.0", ["mpl-header"]),
    ("unlicense-text", "Unlicense", ["unlicense-free"]),
    ("all-rights-reserved", "LicenseRef-all-rights-reserved", ["all-rights"]),
]

SUBJECT = (
    r"^(?:(?:this|the) (?:work|works|software|project|file|document|program|code|source code|text|content|material|library|package|article|page)"
    r" (?:is|are|has been) )"
)
VERB = r"^(?:dual )?(?:licensed|released|distributed|published|available|made available|provided|covered|shared)(?: to you)? under (?:the (?:terms of the )?)?"
# Every known sentence holds one of these words, so other texts need no second look.
TRIGGERS = ("licen", "rights reserved", "permission", "redistribut", "warrant", "spdx", "public domain", "gplv", "under", "conditions")


GRANT, TAG = "licensed under ", "spdx-license-identifier "
# Endings of SPDX identifiers, which stand for the licence or its later versions.
VERSIONS = {"-only": "", "-or-later": "-or-later", "+": "-or-later"}
# What normalisation replaces, in order.
STEPS = (
    ("licence", "license"),
    # A name or definition in brackets behind the licence.
    (r"\((?:the [\"“]?license[\"”]?|[a-z0-9.+\-]{2,20})\)", " "),
    (r"[^a-z0-9.+\-]+", " "),
    (r"(?<![^ ])[.+\-]+|[.\-]+(?![^ ])|(?<![^ ])v\.(?= )|(?<=[^0-9])\+(?![^ ])", ""),
    (r" +", " "),
    (r"^ | $", ""),
)


def known() -> dict[str, str]:
    """Normalised sentence -> identifier."""
    grants = {
        text: f"{kind}:{spdx}"
        for spdx, names in NAMES.items()
        for name in names
        for kind, text in (("grant", f"licensed under {name}"), ("spdx", f"spdx-license-identifier {name}"))
    }
    versions = {
        f"{TAG}{spdx.lower()}{ending}": f"spdx:{spdx}{name}"
        for spdx in NAMES if "GPL" in spdx for ending, name in VERSIONS.items()
    }
    return grants | versions | {text: key for key, text in SENTENCES.items()}


def rules() -> list[tuple[str, str, list[str]]]:
    named = [(f"{kind}-{spdx}", spdx, [f"{kind}:{spdx}"]) for spdx in NAMES for kind in ("grant", "spdx")]
    later = [(f"spdx-{x}-or-later", f"{x}-or-later", [f"spdx:{x}-or-later"]) for x in NAMES if "GPL" in x]
    return TEXT_RULES + named + later


def longer_rules() -> dict[str, list[str]]:
    """Rules that begin with all of another one, by that one."""
    return {
        short: more for short, _, ids in rules()
        if (more := [name for name, _, other in rules() if len(other) > len(ids) and other[: len(ids)] == ids])
    }


def sentences(text: Column, wrapped: bool) -> Column:
    """Normalised sentences; ``wrapped`` joins lines, otherwise lines end sentences."""
    # A colon ends a sentence only at the end of a line: identifiers follow one on their line.
    # The dot of "v. 2.0" ends none.
    dot = r"(?<=[.!?;])(?<![ ,(]v\.)\s+"
    border = rf"{dot}|(?<=:)\s*\n\s*" if wrapped else rf"{dot}|\s*\n\s*"

    def normal(s: Column) -> Column:
        s = F.lower(s)
        for pattern, by in STEPS:
            s = F.regexp_replace(s, pattern, by)
        # The subject goes only with its verb: other known sentences begin with one, too.
        return F.regexp_replace(s, f"{SUBJECT}?{VERB[1:]}", GRANT)

    return F.transform(F.split(text, border), normal)


def parts(sentence: Column, table: Column) -> Column:
    """A known sentence itself, else the sentences that a grant or tag of several licences stands for."""
    several = sentence.rlike(f"^(?:{GRANT}|{TAG})")
    head = F.when(sentence.startswith(GRANT), F.lit(GRANT)).otherwise(F.lit(TAG))
    names = F.split(F.regexp_replace(sentence, f"^(?:{GRANT}|{TAG})(?:either |both )?", ""), r" (?:and|or|and or)(?: the)? ")
    return F.when(F.try_element_at(table, sentence).isNotNull() | ~several, F.array(sentence)).otherwise(
        F.transform(names, lambda name: F.concat(head, name))
    )


def recognised(docs: DataFrame, gap: int = GAP) -> DataFrame:
    """(doc_id, license_id, rule_id, first_sentence, n_sentences)."""
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.filter(F.lower("text").rlike("|".join(TRIGGERS)))
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(known_normalised().items())])
    readings = F.array(
        F.struct(F.lit(0).alias("reading"), sentences(F.col("text"), False).alias("s")),
        F.struct(F.lit(1).alias("reading"), sentences(F.col("text"), True).alias("s")),
    )
    # Hits only; the list of a text is as long as its licence sentences.
    hits = F.filter(
        F.flatten(
            F.transform(
                "s",
                lambda x, at: F.transform(
                    parts(x, table), lambda p: F.struct(at.alias("at"), F.try_element_at(table, p).alias("id"))
                ),
            )
        ),
        lambda h: h["id"].isNotNull(),
    )
    read = texts.select("doc_id", F.explode(readings).alias("r")).select("doc_id", "r.reading", F.col("r.s").alias("s"))
    found = read.select("doc_id", "reading", hits.alias("hits"))
    steps = F.array(
        *[
            F.struct(F.lit(r).alias("rule_id"), F.lit(x).alias("license_id"), F.array(*map(F.lit, ids)).alias("ids"))
            for r, x, ids in rules()
        ]
    )
    tried = found.select("doc_id", "reading", "hits", F.explode_outer(steps).alias("rule")).filter(
        F.arrays_overlap(F.transform("hits", lambda h: h["id"]), F.col("rule.ids"))
    )
    start = F.struct(
        F.lit(0).alias("step"), F.lit(-1).alias("last"), F.lit(-1).alias("begin"), F.lit(-1).alias("found")
    )

    def advance(state: Column, hit: Column) -> Column:
        ids = F.col("rule.ids")
        near = (state["step"] == 0) | (hit["at"] - state["last"] <= gap + 1)
        goes_on = near & (hit["id"] == F.get(ids, state["step"]))
        again = ~goes_on & (hit["id"] == F.get(ids, F.lit(0)))
        step = F.when(goes_on, state["step"] + 1).when(again, 1).when(near, state["step"]).otherwise(0)
        begin = F.when((goes_on & (state["step"] == 0)) | again, hit["at"]).otherwise(state["begin"])
        done = (step == F.size(ids)) & (goes_on | again)
        return F.struct(
            F.when(done, 0).otherwise(step).alias("step"),
            F.when(goes_on | again, hit["at"]).otherwise(state["last"]).alias("last"),
            begin.alias("begin"),
            F.when(done & (state["found"] < 0), begin).otherwise(state["found"]).alias("found"),
        )

    state = tried.select("doc_id", "reading", "rule", F.aggregate("hits", start, advance).alias("state"))
    longer = F.create_map(*[x for short, more in longer_rules().items() for x in (F.lit(short), F.array(*map(F.lit, more)))])
    matched = (
        state.filter(F.col("state.found") >= 0)
        .groupBy("doc_id", F.col("rule.license_id").alias("license_id"), F.col("rule.rule_id").alias("rule_id"))
        .agg(F.min(F.struct("reading", "state.found")).alias("m"), F.first(F.size("rule.ids")).alias("n_sentences"))
    )
    # As many rows as rules at most meet here.
    beside = F.collect_set("rule_id").over(Window.partitionBy("doc_id", "m"))
    covered = F.arrays_overlap(F.try_element_at(longer, F.col("rule_id")), beside)
    return (
        matched.withColumn("covered", F.coalesce(covered, F.lit(False))).filter(~F.col("covered"))
        .select("doc_id", "license_id", "rule_id", F.col("m.found").alias("first_sentence"), "n_sentences")
    )


def known_normalised() -> dict[str, str]:
    """The known sentences as the sentences of texts are normalised."""

    def normal(text: str) -> str:
        text = text.lower()
        for pattern, by in STEPS:
            text = re.sub(pattern, by, text)
        return text

    return {normal(text): key for text, key in known().items()}
