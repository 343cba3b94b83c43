"""Licence recognition by sentences, in DataFrame functions only.

Texts are lower-cased (A-Z) and every run of other characters than a-z and 0-9
becomes one space. Sentences end at ``. ! ?`` before white space and at blank lines.
They may also begin or end at a line end or after ``:`` or ``;`` but run on
there too, so notices are known wrapped, behind comment signs and on one line. Marks of a list
(``1.``, ``(b)``) where a sentence may begin are no part of it.

Sentences that are known, in their standard or another usual wording, give their number; short notices
only as whole sentences, words of a licence itself wherever they stand. The numbers of a document, in order, are matched with the rules in order. A rule matches where its
numbers stand next to one another, and what it matched is not matched again,
so a longer licence text comes before a part of it.

Null text has no sentences. Each row is judged on its own. New columns whose names are taken get
underscores before them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.llm.batches import free_name

# fixed values: normalised sentences of common licence notices; a sentence's number is its place
SENTENCES = (
    "licensed under the apache license version 2 0",
    "released under the mit license",
    "this work is licensed under the gnu general public license version 3",
    "licensed under cc by nc 4 0",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "you should have received a copy of the gnu general public license along with this program",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache license version 2 0 january 2004",
    "gnu general public license version 3 29 june 2007",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "this source code form is subject to the terms of the mozilla public license v 2 0",
    "this is free and unencumbered software released into the public domain",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
)

# fixed values: SPDX identifiers as they read when normalised, with other usual names of the licence (patterns)
NAMES = (
    ("MIT", "mit", "(?:mit|expat) licen[cs]e"),
    ("ISC", "isc", "isc licen[cs]e"),
    ("Apache-2.0", "apache 2 0", "(?:apache(?: software)? licen[cs]e(?: version| v)? ?2(?: 0)?|apache 2(?: 0)? licen[cs]e)"),
    ("BSD-2-Clause", "bsd 2 clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd) licen[cs]e"),
    ("BSD-3-Clause", "bsd 3 clause", "(?:(?:new|modified|revised) bsd|bsd 3 clause|3 clause bsd) licen[cs]e"),
    ("MPL-2.0", "mpl 2 0", "mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("GPL-2.0", "gpl 2 0", "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?2(?: 0)?"),
    ("GPL-3.0", "gpl 3 0", "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?3(?: 0)?"),
    ("LGPL-2.1", "lgpl 2 1", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?2 1"),
    ("LGPL-3.0", "lgpl 3 0", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?3(?: 0)?"),
    ("AGPL-3.0", "agpl 3 0", "(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: version| v)? ?3(?: 0)?"),
    ("Unlicense", "unlicense", "unlicense"),
    ("CC0-1.0", "cc0 1 0", "(?:creative commons zero|cc0)(?: version| v)?(?: 1 0)?(?: universal)?(?: licen[cs]e)?"),
    ("CC-BY-4.0", "cc by 4 0", "creative commons attribution 4 0(?: international)?(?: licen[cs]e)?"),
    ("CC-BY-SA-4.0", "cc by sa 4 0", "creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)?"),
    ("CC-BY-NC-4.0", "cc by nc 4 0", "creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)?"),
)
_TAGS = len(SENTENCES)  # numbers of the identifiers begin here, those of the notices that name a licence after them
SENTENCES += tuple(f"spdx license identifier {tag}" for _, tag, _ in NAMES) + tuple(f"licensed under {tag}" for _, tag, _ in NAMES)

# these are known only whole, the other sentences also inside a sentence
WHOLE = (*range(6), *range(_TAGS, len(SENTENCES)))

# fixed values: patterns of other usual wordings of a sentence, by its number; ``WORDS`` stands for a name
_DISCLAIMER = "this list of conditions and the following disclaimers?"
_ENDORSE = "be used to endorse or promote products derived from (?:this|the) software without (?:specific )?prior (?:written )?permission"
VARIANTS = {n: tuple(v.replace("WORDS ", "(?:[a-z0-9]+[|/ ]){1,15}?") for v in variants) for n, variants in {
    6: ("permission is hereby granted free of charge to any person obtaining a copy of this software and (?:or )?(?:its )?(?:associated )?documentation (?:source )?files? the software to deal in the software without restriction including without limitation (?:on )?the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions?",),
    7: ("the above copyright notices? and this permission notice (?:including the next paragraph )?shall be included in (?:all|the) copies or substantial portions of the software",),
    8: ("redistribution and use (?:of WORDS )?in source and binary forms (?:of WORDS )?with or without modification (?:of WORDS )?(?:are|is) permitted provided that the following conditions are met",),
    9: (f"redistributions? of source code must retain the (?:above |original )?copyright notices? {_DISCLAIMER}",),
    10: (f"redistributions? in binary form must reproduce the (?:above |original )?copyright notices? {_DISCLAIMER} in the documentation and or (?:any )?other materials provided with the distribution",
         "redistributions? in binary form must reproduce the (?:above |original )?copyright notices? this list of conditions and the disclaimer that follows these conditions in the documentation and or other materials provided with the distribution"),
    11: (f"neither the names? (?:of )?WORDS (?:may|nor WORDS may) {_ENDORSE}",
         f"the names? WORDS (?:may|must) not {_ENDORSE}"),
    12: ("is free software you (?:can|may) redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation (?:either )?version 3",),
    13: ("you should have received a copy of the gnu general public license (?:along|together) with",),
    14: ("licensed under the apache license version 2 0 the license you may not use (?:this|these|the) (?:WORDS )?except in (?:compliance|accordance) with the license",
         "licenses? (?:this|these) (?:files?|work|software) (?:to you )?under the apache license version 2 0 the license you may not use (?:this|these) (?:files?|work|software) except in compliance with the license"),
    15: ("apache license[|/ ]version 2 0[|/ ]january 2004",),
    16: ("gnu general public license[|/ ]version 3[|/ ]29 june 2007",),
    17: ("licensed under (?:a|the) creative commons attribution non ?commercial 4 0 (?:international )?(?:public )?license",),
    18: ("licensed under (?:a|the) creative commons attribution 4 0 (?:international )?(?:public )?license",),
    19: ("licensed under (?:a|the) creative commons attribution share ?alike 4 0 (?:international )?(?:public )?license",),
    21: ("permission to use copy modify (?:and or|and) distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",),
    22: ("subject to the terms of the mozilla public license v[|/ ]?2[|/ ]0",),
    24: ("under the terms of the gnu general public license as published by the free software foundation (?:either )?version 2",),
    25: ("under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation (?:either )?version 2[|/ ]1",),
    26: ("under the terms of the gnu lesser general public license as published by the free software foundation (?:either )?version 3",),
    27: ("under the terms of the gnu affero general public license as published by the free software foundation (?:either )?version 3",),
    20: ("all advertising materials mentioning features or use of this software must display the following acknowledge?ment",),
}.items()}
_UNDER = "(?:(?:this|the) [a-z0-9]+ (?:is|are) )?(?:licen[cs]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of the )?"
VARIANTS |= {_TAGS + i: (f"spdx licen[cs]e identifier {tag}(?: only| or later)?",) for i, (_, tag, _) in enumerate(NAMES)}
VARIANTS |= {_TAGS + len(NAMES) + i: (f"{_UNDER}(?:{tag}|{name})(?: only| or later)?",) for i, (_, tag, name) in enumerate(NAMES)}

# fixed values: licence and the sentence numbers it needs, in the order they are tried
RULES = (
    ("BSD-4-Clause", (8, 9, 10, 20, 11)),
    ("BSD-3-Clause", (8, 9, 10, 11)),
    ("BSD-2-Clause", (8, 9, 10)),
    ("MIT", (6, 7)),
    ("GPL-3.0", (12, 13)),
    ("Apache-2.0", (0,)),
    ("MIT", (1,)),
    ("GPL-3.0", (2,)),
    ("CC-BY-NC-4.0", (3,)),
    ("CC-BY-SA-4.0", (5,)),
    ("CC-BY-4.0", (4,)),
    ("Apache-2.0", (14,)),
    ("Apache-2.0", (15,)),
    ("GPL-3.0", (16,)),
    ("CC-BY-NC-4.0", (17,)),
    ("CC-BY-SA-4.0", (19,)),
    ("CC-BY-4.0", (18,)),
    ("ISC", (21,)),
    ("MPL-2.0", (22,)),
    ("Unlicense", (23,)),
    ("GPL-2.0", (24,)),
    ("LGPL-2.1", (25,)),
    ("LGPL-3.0", (26,)),
    ("AGPL-3.0", (27,)),
    *((name, (k + i,)) for k in (_TAGS, _TAGS + len(NAMES)) for i, (name, _, _) in enumerate(NAMES)),
)

# steps from lower-cased text to words with ``|`` where a sentence ends and ``/`` where it may end
_STEPS = (
    (r"(^|\n|[.:;!?]\s)[^a-z0-9\n]{0,20}(?:[0-9]{1,2}|[a-z]|i{2,3})[.)][ \t]+", "$1 "),
    (r"[.!?](?=\s|$)", "|"),
    (r"[:;](?=[ \t]+\S)|\n", "/"),
    (r"[^a-z0-9|/]+", " "),
    (r" ?[|/][ |/]*[|/] ?", "|"),
    (r" ?([|/]) ?", "$1"),
)


def _pattern(number: int) -> str:
    return "(?:" + "|".join((*VARIANTS.get(number, ()), SENTENCES[number])).replace(" ", "[ /]").replace("[|/[ /]]", "[|/ ]") + ")"


def sentence_numbers(text: Column) -> Column:
    """The numbers of the known sentences of a text, in order."""
    words = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ|/", "abcdefghijklmnopqrstuvwxyz  ")
    words = F.concat(F.lit("\n\n"), words, F.lit("\n\n"))
    for pattern, by in _STEPS:
        words = F.regexp_replace(words, pattern, by)
    whole = "|".join(map(_pattern, WHOLE))
    longer = "|".join(_pattern(n) for n in range(len(SENTENCES)) if n not in WHOLE)
    known = f"(?<=[|/ ])(?:{longer})(?=[|/ ])|(?<=[|/])(?:{whole})(?=[|/])"
    found = F.regexp_extract_all(words, F.lit(known), F.lit(0))
    return F.transform(found, lambda s: F.coalesce(*[
        F.when(F.rlike(s, F.lit(f"^{_pattern(n)}$")), n) for n in range(len(SENTENCES))]))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with sentence_numbers array<int> and licences array<string>, in rule order, without repeats."""
    numbers_name, left_name = free_name(docs, "sentence_numbers"), free_name(docs, "_left")
    numbered = docs.withColumn(numbers_name, sentence_numbers(F.col(text)))
    left = F.array_join(F.transform(numbers_name, lambda n: F.concat(F.lit(";"), n.cast("string"), F.lit(";"))), "")
    found = []
    numbered = numbered.withColumn(left_name, left)
    rest = F.col(left_name)
    for name, numbers in RULES:
        wanted = "".join(f";{n};" for n in numbers)
        found.append(F.when(F.contains(rest, F.lit(wanted)), F.lit(name)))
        rest = F.replace(rest, F.lit(wanted), F.lit(";-;"))
    names = F.array_distinct(F.filter(F.array(*found), lambda x: x.isNotNull()))
    return numbered.withColumn(free_name(docs, "licences"), names).drop(left_name)
