"""Licence scans by sentence rules: sentences -> identifiers -> ordered rules.

A text is normalised and split into sentences; each is looked up in the map from known
licence sentences to identifiers. A sentence that is not in the map as it stands may
hold known ones, wrapped or in a longer sentence: if one of the ``anchors`` stands in it
(few words, chosen from the table so that every known sentence has one), the known
sentences are found in it as runs of whole words. The sequence of a text's identifiers
is matched against the rules in order, and the first rule that matches names the
licence. Texts without an anchor are not even normalised: they hold no known sentence.
All of it is one projection over native functions: no join, no shuffle, no Python.

Defined cases: a null or empty text has no sentences and no licence. A sentence ends
at a line without letters or digits, or at . ! ? before a blank or the end; a known
sentence may go on over other line feeds (wrapped headers, with or without comment signs)
and stand inside a longer one. Short ones (``WHOLE``) must be a whole line or sentence,
as their words also stand in prose. Where known sentences overlap, the first and then the
longest counts. Letters outside ASCII count as blanks. A sentence that occurs twice is in
the sequence twice. Other columns pass through; one named like an output raises an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_clash

# Identifier, normalised sentence (lower case, runs of other signs as one blank).
SENTENCES: tuple[tuple[str, str], ...] = (
    ("apache2_short", "licensed under the apache license version 2 0"),
    ("apache2_grant", "licensed under the apache license version 2 0 the license"),
    ("apache2_except", "you may not use this file except in compliance with the license"),
    ("apache2_copy", "you may obtain a copy of the license at"),
    ("mit_short", "released under the mit license"),
    ("mit_title", "the mit license"),
    ("mit_title", "mit license"),
    ("mit_notice", "the above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the software"),
    ("as_is", "the software is provided as is without warranty of any kind express or implied"),
    ("bsd_redist", "redistribution and use in source and binary forms with or without modification are permitted "
                   "provided that the following conditions are met"),
    ("bsd_endorse", "neither the name of the copyright holder nor the names of its contributors may be used to "
                    "endorse or promote products derived from this software without specific prior written permission"),
    ("gpl3_short", "this work is licensed under the gnu general public license version 3"),
    ("gpl_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 3 of the "
                 "license or at your option any later version"),
    ("ccbync4_short", "licensed under cc by nc 4 0"),
    ("ccby4_short", "licensed under cc by 4 0"),
    ("ccbysa4_short", "licensed under cc by sa 4 0"),
    ("ccby4_long", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights "
            "to this work"),
    ("mit_title", "the mit license mit"),
    ("gpl2_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation either version 2 of the "
                  "license or at your option any later version"),
    ("agpl3_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "affero general public license as published by the free software foundation either version 3 of "
                   "the license or at your option any later version"),
    ("lgpl3_free", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 3 of "
                   "the license or at your option any later version"),
    ("lgpl3_free", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 3 of "
                   "the license or at your option any later version"),
    ("lgpl21_free", "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                    "lesser general public license as published by the free software foundation either version 2 1 of "
                    "the license or at your option any later version"),
    ("mpl2", "this source code form is subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("bsl1", "distributed under the boost software license version 1 0"),
    ("ccbysa4_long", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("ccbync4_long", "this work is licensed under a creative commons attribution noncommercial 4 0 international "
                     "license"),
    ("reserved", "all rights reserved"),
)

# Identifiers of sentences that count only as a whole line or sentence.
WHOLE = frozenset({"mit_title", "reserved"})

# Ordered rules; each is a licence, its class, and identifiers that must follow in this order.
RULES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("BSD-3-Clause", "permissive", ("bsd_redist", "bsd_endorse")),
    ("BSD-2-Clause", "permissive", ("bsd_redist",)),
    ("MIT", "permissive", ("mit_title", "mit_notice")),
    ("MIT", "permissive", ("mit_notice", "as_is")),
    ("GPL-3.0-or-later", "copyleft", ("gpl_free",)),
    ("GPL-3.0-only", "copyleft", ("gpl3_short",)),
    ("CC-BY-NC-4.0", "restricted", ("ccbync4_short",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccbysa4_short",)),
    ("Apache-2.0", "permissive", ("apache2_grant", "apache2_except", "apache2_copy")),
    ("Apache-2.0", "permissive", ("apache2_short",)),
    ("MIT", "permissive", ("mit_short",)),
    ("MIT", "permissive", ("mit_title",)),
    ("CC-BY-4.0", "permissive", ("ccby4_long",)),
    ("CC-BY-4.0", "permissive", ("ccby4_short",)),
    ("CC0-1.0", "permissive", ("cc0",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2_free",)),
    ("AGPL-3.0-or-later", "copyleft", ("agpl3_free",)),
    ("LGPL-3.0-or-later", "copyleft", ("lgpl3_free",)),
    ("LGPL-2.1-or-later", "copyleft", ("lgpl21_free",)),
    ("MPL-2.0", "copyleft", ("mpl2",)),
    ("ISC", "permissive", ("isc",)),
    ("Unlicense", "permissive", ("unlicense",)),
    ("BSL-1.0", "permissive", ("bsl1",)),
    ("CC-BY-SA-4.0", "copyleft", ("ccbysa4_long",)),
    ("CC-BY-NC-4.0", "restricted", ("ccbync4_long",)),
    ("Apache-2.0", "permissive", ("apache2_grant",)),
    ("BSD-3-Clause", "permissive", ("bsd_endorse",)),
    ("MIT", "permissive", ("mit_notice",)),
    ("all-rights-reserved", "restricted", ("reserved",)),
)

# What splits and normalises.
NOT_ASCII = r"[^\x00-\x7F]+"
SENTENCE_END = r"[.!?]+([ \t\r]|$|\n)"
EMPTY_LINE = r"\n[^a-z0-9\n]*(?=\n)"
OTHER_SIGNS = r"[^a-z0-9]+"


def words_and_marks(text: Column) -> Column:
    """Lower-case words of a text between blanks, H where a sentence ends, S at other line feeds."""
    plain = F.lower(F.regexp_replace(text, NOT_ASCII, " "))
    ended = F.regexp_replace(F.regexp_replace(plain, SENTENCE_END, " H "), EMPTY_LINE, " H ")
    marked = F.concat(F.lit(" H "), F.replace(ended, F.lit("\n"), F.lit(" S ")), F.lit(" H "))
    return F.regexp_replace(marked, r"[^a-z0-9HS]+", " ")


def known_pattern(known: Sequence[tuple[str, str]]) -> str:
    """The known sentences as a pattern over words and marks, the longest first."""
    run = lambda s: s.replace(" ", " (?:S )?")
    return "|".join(rf"(?<=[HS] ){run(s)}(?= [HS])" if i in WHOLE else rf"(?<= ){run(s)}(?= )"
                    for i, s in sorted(known, key=lambda x: -len(x[1])))


def anchors(known: Sequence[tuple[str, str]]) -> list[str]:
    """Words of which every known sentence has one: again and again the word that most of those left have
    (of these the longest, then the first by the alphabet)."""
    left, out = {s for _, s in known}, []
    while left:
        words = {w for s in left for w in s.split()}
        best = min(words, key=lambda w: (-sum(w in s.split() for s in left), -len(w), w))
        out.append(best)
        left = {s for s in left if best not in s.split()}
    return out


def holds_anchor(text: Column, known: Sequence[tuple[str, str]]) -> Column:
    """Whether an anchor is anywhere in a lower-case text (also inside a word): without one it has no known sentence."""
    return reduce(or_, [F.contains(text, F.lit(w)) for w in anchors(known)])


def sentence_ids(text: Column, known: Sequence[tuple[str, str]] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order (the table of known sentences is a short constant)."""
    name = F.create_map(*[F.lit(x) for i, s in dict((s, i) for i, s in known).items() for x in (i, s)])
    plain = lambda run: F.trim(F.regexp_replace(F.concat(F.lit(" "), run, F.lit(" ")), r"( S)* ", " "))

    def ids(sentence: Column) -> Column:
        """Of one sentence with its marks."""
        whole = F.element_at(name, plain(sentence))
        runs = F.regexp_extract_all(F.concat(F.lit("H "), sentence, F.lit(" H")), F.lit(known_pattern(known)), F.lit(0))
        inside = F.transform(runs, lambda r: F.element_at(name, plain(r)))
        none = F.array().cast("array<string>")
        return F.when(whole.isNotNull(), F.array(whole)).when(holds_anchor(sentence, known), inside).otherwise(none)

    sentences = F.split(F.regexp_replace(words_and_marks(text), r"^ H | H $", ""), r" (?:H )+", -1)
    return F.when(holds_anchor(F.lower(text), known), F.flatten(F.transform(sentences, ids)))


def rule_pattern(ids: Sequence[str]) -> str:
    """A rule as a pattern over ' id id id ': its identifiers in order, others may stand between."""
    return " " + " ([a-z0-9_]+ )*".join(ids) + " "


def scan(docs: DataFrame, text_col: str = "text", known: Sequence[tuple[str, str]] = SENTENCES,
         rules: Sequence[tuple[str, str, tuple[str, ...]]] = RULES,
         out: tuple[str, str, str, str] = ("licence", "licence_class", "licence_rule", "sentence_ids")) -> DataFrame:
    """``docs`` with licence, class, number of the rule (from 1) and the identifiers, blank-separated."""
    no_clash(docs, *out)
    ids = F.coalesce(sentence_ids(F.col(text_col), known), F.array().cast("array<string>"))
    found = docs.withColumns({out[3]: F.array_join(ids, " ")})
    seq = F.concat(F.lit(" "), F.col(out[3]), F.lit(" "))
    rule = F.coalesce(*[F.when(seq.rlike(rule_pattern(r[2])), F.lit(n)) for n, r in enumerate(rules, 1)])
    found = found.withColumn(out[2], rule)
    pick = lambda k: F.coalesce(*[F.when(F.col(out[2]) == n, F.lit(r[k])) for n, r in enumerate(rules, 1)])
    return found.withColumns({out[0]: pick(0), out[1]: pick(1)})
