"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences, each is normalised, known sentences become identifiers, and the
sequence of identifiers is held against ordered licence rules. A sentence may be wrapped over lines. Sentences
with slots (holder, subject, what follows the licence's name), SPDX lines and addresses are found by patterns.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and the identifier of each.
SENTENCES = {
    "released under the mit license": "mit.notice",
    "licensed under the mit license": "mit.notice",
    "the mit license": "mit.title",
    "the mit license mit": "mit.title",
    "mit license": "mit.title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit.grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit.notice_kept",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit.warranty",
    "licensed under the apache license version 2 0": "apache2.notice",
    "licensed under the apache license version 2 0 the license": "apache2.notice",
    "you may not use this file except in compliance with the license": "apache2.compliance",
    "you may obtain a copy of the license at": "apache2.copy",
    "apache license version 2 0": "apache2.title",
    "this work is licensed under the gnu general public license version 3": "gpl3.notice",
    "licensed under the gnu general public license version 3": "gpl3.notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3.grant",
    "gnu general public license version 3": "gpl3.title",
    "gnu lesser general public license version 3": "lgpl3.title",
    "licensed under cc by nc 4 0": "ccbync4.notice",
    "this work is licensed under cc by nc 4 0": "ccbync4.notice",
    "licensed under cc by 4 0": "ccby4.notice",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4.notice",
    "licensed under cc by sa 4 0": "ccbysa4.notice",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4.notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd.grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd.endorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed": "bsd.warranty",
    "this is free and unencumbered software released into the public domain": "unlicense.grant",
    "all rights reserved": "reserved",
    "this program is free software": "gpl.free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl.terms",
    "either version 2 of the license or at your option any later version": "v2.later",
    "either version 3 of the license or at your option any later version": "v3.later",
    "gnu general public license version 2": "gpl2.title",
    "licensed under the gnu general public license version 2": "gpl2.notice",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3.grant",
    "gnu affero general public license version 3": "agpl3.title",
    "this library is free software": "lgpl.free",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl.terms",
    "either version 2 1 of the license or at your option any later version": "v21.later",
    "gnu lesser general public license version 2 1": "lgpl21.title",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2.notice",
    "mozilla public license version 2 0": "mpl2.title",
    "isc license": "isc.title",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc.grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc.warranty",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0.notice",
    "cc0 1 0 universal": "cc0.title",
}

# Sentences as the cutter yields them from the published texts, where SENTENCES has another form.
PUBLISHED = {
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3.grant",
    "gnu general public license version 3 29 june 2007": "gpl3.title",
    "gnu lesser general public license version 3 29 june 2007": "lgpl3.title",
    "gnu general public license version 2 june 1991": "gpl2.title",
    "gnu affero general public license version 3 19 november 2007": "agpl3.title",
    "gnu lesser general public license version 2 1 february 1999": "lgpl21.title",
    "apache license version 2 0 january 2004 http www apache org licenses": "apache2.title",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4.notice",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd.warranty",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl1.grant",
    "boost software license version 1 0 august 17th 2003": "bsl1.title",
    "boost software license version 1 0": "bsl1.title",
    "eclipse public license v 2 0": "epl2.title",
    "zlib license": "zlib.title",
    "this software is provided as is without any express or implied warranty": "zlib.warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib.grant",
    "bsd zero clause license": "0bsd.title",
    "zero clause bsd": "0bsd.title",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd.grant",
    "the artistic license 2 0": "artistic2.title",
    "artistic license 2 0": "artistic2.title",
    "do what the fuck you want to public license": "wtfpl.title",
    "you just do what the fuck you want to": "wtfpl.grant",
    "sil open font license version 1 1": "ofl11.title",
    "sil open font license version 1 1 26 february 2007": "ofl11.title",
    "mit no attribution": "mit0.title",
    "bsd 3 clause license": "bsd3.title",
    "bsd 2 clause license": "bsd2.title",
    "european union public licence v 1 2": "eupl12.title",
    "creative commons attribution noderivatives 4 0 international license": "ccbynd4.title",
    "attribution noderivatives 4 0 international": "ccbynd4.title",
}
KNOWN = SENTENCES | PUBLISHED

# What notices and SPDX lines call a licence, as patterns of normalised text; the first that fits counts.
NAMES = {
    "mit0": "mit 0|mit no attribution",
    "mit": "mit(?: x11)?|x11 mit|expat",
    "apache2": "apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?(?: only)?|apache ?v?2(?: 0)?",
    "agpl3l": "agpl 3 0 or later",
    "agpl3": "(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: version| v)? ?v?3(?: 0)?(?: only)?",
    "lgpl3l": "lgpl 3 0 or later",
    "lgpl21l": "lgpl 2 1 or later",
    "lgpl21": "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?v?2 1(?: only)?",
    "lgpl3": "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?v?3(?: 0)?(?: only)?",
    "gpl3l": "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?v?3(?: 0)?(?: or later|(?: or at your option)? any later version)",
    "gpl2l": "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?v?2(?: 0)?(?: or later|(?: or at your option)? any later version)",
    "gpl3": "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?v?3(?: 0)?(?: only)?",
    "gpl2": "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?v?2(?: 0)?(?: only)?",
    "mpl2": "(?:mozilla public licen[cs]e|mpl)(?: version| v)? ?v?2(?: 0)?",
    "0bsd": "0bsd|zero clause bsd|bsd zero clause",
    "bsd3": "bsd 3 clause(?: new or revised)?|3 clause bsd|(?:new|modified|revised) bsd",
    "bsd2": "bsd 2 clause(?: simplified)?|2 clause bsd|simplified bsd",
    "isc": "isc",
    "unlicense": "unlicense",
    "cc0": "(?:creative commons )?cc0(?: 1 0)?(?: universal)?",
    "ccbync4": "cc by nc 4 0|creative commons attribution noncommercial 4 0 international",
    "ccbysa4": "cc by sa 4 0|creative commons attribution sharealike 4 0 international",
    "ccbynd4": "cc by nd 4 0|creative commons attribution noderivatives 4 0 international",
    "ccby4": "cc by 4 0|creative commons attribution 4 0 international",
    "bsl1": "(?:boost software licen[cs]e|bsl)(?: version)? 1 0",
    "epl2": "(?:eclipse public licen[cs]e|epl)(?: version| v)? ?v?2 0",
    "zlib": "zlib(?: libpng)?",
    "artistic2": "artistic(?: licen[cs]e)?(?: version)? 2 0",
    "wtfpl": "wtfpl",
    "ofl11": "(?:sil open font licen[cs]e|ofl)(?: version)? 1 1",
    "eupl12": "(?:european union public licen[cs]e|eupl)(?: version| v)? ?v?1 2",
}
# Addresses of licences, as patterns of normalised text.
ADDRESSES = {
    "mit": "opensource org licenses? mit", "apache2": "apache org licenses license 2 0(?: html| txt)?", "gpl3": "gnu org licenses gpl 3 0(?: en)?(?: html| txt)?", "gpl2": "gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?",
    "lgpl3": "gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?", "lgpl21": "gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?", "agpl3": "gnu org licenses agpl 3 0(?: en)?(?: html| txt)?", "mpl2": "mozilla org mpl 2 0",
    "bsd3": "opensource org licenses? bsd 3 clause", "bsd2": "opensource org licenses? bsd 2 clause", "isc": "opensource org licenses? isc", "unlicense": "unlicense org", "cc0": "creativecommons org publicdomain zero 1 0",
    "ccbync4": "creativecommons org licenses by nc 4 0", "ccbysa4": "creativecommons org licenses by sa 4 0", "ccbynd4": "creativecommons org licenses by nd 4 0", "ccby4": "creativecommons org licenses by 4 0",
    "bsl1": "boost org license 1 0 txt", "epl2": "eclipse org legal epl (?:2 0|v20 html)", "zlib": "opensource org licenses? zlib",
}

# Rules in the order in which they are tried. A rule holds if its identifiers occur in
# this order, with anything between; a rule hides the later rules of the same family.
RULES = (
    ("MIT", "mit", ("mit.grant", "mit.notice_kept", "mit.warranty")),
    ("MIT", "mit", ("mit.title", "mit.grant")),
    ("MIT", "mit", ("mit.grant",)),
    ("MIT-0", "mit", ("mit0.title",)),
    ("MIT", "mit", ("mit.notice",)),
    ("MIT", "mit", ("mit.title",)),
    ("Apache-2.0", "apache", ("apache2.notice", "apache2.compliance", "apache2.copy")),
    ("Apache-2.0", "apache", ("apache2.notice",)),
    ("Apache-2.0", "apache", ("apache2.title",)),
    ("GPL-3.0-or-later", "gpl", ("gpl3.grant",)),
    ("GPL-3.0-or-later", "gpl", ("gpl.terms", "v3.later")),
    ("GPL-2.0-or-later", "gpl", ("gpl.terms", "v2.later")),
    ("GPL-3.0-only", "gpl", ("gpl3.notice",)),
    ("GPL-2.0-only", "gpl", ("gpl2.notice",)),
    ("GPL-3.0-only", "gpl", ("gpl3.title",)),
    ("GPL-2.0-only", "gpl", ("gpl2.title",)),
    ("AGPL-3.0-or-later", "agpl", ("agpl3.grant",)),
    ("AGPL-3.0-only", "agpl", ("agpl3.title",)),
    ("LGPL-2.1-or-later", "lgpl", ("lgpl.terms", "v21.later")),
    ("LGPL-3.0-or-later", "lgpl", ("lgpl.terms", "v3.later")),
    ("LGPL-3.0-only", "lgpl", ("lgpl3.title",)),
    ("LGPL-2.1-only", "lgpl", ("lgpl21.title",)),
    ("MPL-2.0", "mpl", ("mpl2.notice",)),
    ("MPL-2.0", "mpl", ("mpl2.title",)),
    ("ISC", "isc", ("isc.grant", "isc.warranty")),
    ("ISC", "isc", ("isc.grant",)),
    ("ISC", "isc", ("isc.title",)),
    ("0BSD", "isc", ("0bsd.grant",)),
    ("0BSD", "isc", ("0bsd.title",)),
    ("CC0-1.0", "cc", ("cc0.notice",)),
    ("CC0-1.0", "cc", ("cc0.title",)),
    ("CC-BY-NC-4.0", "cc", ("ccbync4.notice",)),
    ("CC-BY-SA-4.0", "cc", ("ccbysa4.notice",)),
    ("CC-BY-4.0", "cc", ("ccby4.notice",)),
    ("BSD-3-Clause", "bsd", ("bsd.grant", "bsd.endorse", "bsd.warranty")),
    ("BSD-3-Clause", "bsd", ("bsd.grant", "bsd.endorse")),
    ("BSD-3-Clause", "bsd", ("bsd3.title",)),
    ("BSD-2-Clause", "bsd", ("bsd.grant", "bsd.warranty")),
    ("BSD-2-Clause", "bsd", ("bsd2.title",)),
    ("BSD-2-Clause", "bsd", ("bsd.grant",)),
    ("Unlicense", "unlicense", ("unlicense.grant",)),
    ("BSL-1.0", "bsl", ("bsl1.grant",)),
    ("BSL-1.0", "bsl", ("bsl1.title",)),
    ("EPL-2.0", "epl", ("epl2.title",)),
    ("Zlib", "zlib", ("zlib.warranty", "zlib.grant")),
    ("Zlib", "zlib", ("zlib.grant",)),
    ("Zlib", "zlib", ("zlib.title",)),
    ("Artistic-2.0", "artistic", ("artistic2.title",)),
    ("WTFPL", "wtfpl", ("wtfpl.title",)),
    ("WTFPL", "wtfpl", ("wtfpl.grant",)),
    ("OFL-1.1", "ofl", ("ofl11.title",)),
    ("EUPL-1.2", "eupl", ("eupl12.title",)),
    ("CC-BY-ND-4.0", "cc", ("ccbynd4.title",)),
    ("LicenseRef-all-rights-reserved", "reserved", ("reserved",)),
)

# The SPDX name and the family of each licence that a notice, an SPDX line or an address can name.
NAMED = {
    "mit0": ("MIT-0", "mit"), "mit": ("MIT", "mit"), "apache2": ("Apache-2.0", "apache"), "agpl3l": ("AGPL-3.0-or-later", "agpl"), "agpl3": ("AGPL-3.0-only", "agpl"), "lgpl3l": ("LGPL-3.0-or-later", "lgpl"),
    "lgpl21l": ("LGPL-2.1-or-later", "lgpl"), "lgpl21": ("LGPL-2.1-only", "lgpl"), "lgpl3": ("LGPL-3.0-only", "lgpl"), "gpl3l": ("GPL-3.0-or-later", "gpl"), "gpl2l": ("GPL-2.0-or-later", "gpl"), "gpl3": ("GPL-3.0-only", "gpl"),
    "gpl2": ("GPL-2.0-only", "gpl"), "mpl2": ("MPL-2.0", "mpl"), "0bsd": ("0BSD", "isc"), "bsd3": ("BSD-3-Clause", "bsd"), "bsd2": ("BSD-2-Clause", "bsd"), "isc": ("ISC", "isc"), "unlicense": ("Unlicense", "unlicense"), "cc0": ("CC0-1.0", "cc"),
    "ccbync4": ("CC-BY-NC-4.0", "cc"), "ccbysa4": ("CC-BY-SA-4.0", "cc"), "ccbynd4": ("CC-BY-ND-4.0", "cc"), "ccby4": ("CC-BY-4.0", "cc"), "bsl1": ("BSL-1.0", "bsl"), "epl2": ("EPL-2.0", "epl"), "zlib": ("Zlib", "zlib"),
    "artistic2": ("Artistic-2.0", "artistic"), "wtfpl": ("WTFPL", "wtfpl"), "ofl11": ("OFL-1.1", "ofl"), "eupl12": ("EUPL-1.2", "eupl"),
}
# sentences with slots come after the fixed ones of their family, notices and SPDX lines before addresses
_STATED = {(name, ids) for name, _, ids in RULES}
RULES = RULES + tuple(
    (*NAMED[k], (f"{k}.{how}",)) for how, names in (("spdx", NAMES), ("notice", NAMES), ("url", ADDRESSES)) for k in names if (NAMED[k][0], (f"{k}.{how}",)) not in _STATED
)

#: Every known sentence holds one of these, so a text without any has no known sentence.
CUES = ("licen", "permission", "copyright", "software", "redistribut", "reserved", "cc0", "spdx", "wtfpl", "eupl", "gpl", "bsd", "mozilla.org/mpl", "epl-", "publicdomain", "do what the fuck", "without any express", "no attribution", "noderivatives")
_CUED = "(?i)" + "|".join(c.replace(".", "[.]") for c in CUES)

#: A marker stands for a sentence with slots; it has a sign that normalised text has not.
_GAP = "[ \n]"
_wide = lambda x: x.replace(" ", _GAP)
_FREE = r"(?:(?!not\b|never\b)[a-z0-9]+[ \n]){0,8}"
_UNDER = rf"(?:licen[cs]ed|released|distributed|available|published|provided|covered|redistributed){_GAP}(?:as{_GAP}open{_GAP}source{_GAP})?under{_GAP}(?:the{_GAP})?(?:terms{_GAP}(?:and{_GAP}conditions{_GAP})?of{_GAP}(?:the{_GAP})?)?"
_TAIL = rf"(?:{_GAP}(?:version|licen[cs]e[sd]?|term[s]?))?(?:{_GAP}(?:the{_GAP})?(?:licen[cs]e|see|which|as|found|for|in|a)\b[a-z0-9 \n]{{0,300}})?"
SLOTTED = (
    # the holder's name
    (rf"(?<![a-z0-9])neither{_GAP}the{_GAP}names?{_GAP}of{_GAP}[a-z0-9 \n]{{1,200}}?{_GAP}nor{_GAP}the{_GAP}names?{_GAP}of{_GAP}[a-z0-9 \n]{{1,100}}?contributors{_GAP}may{_GAP}be{_GAP}used{_GAP}to{_GAP}endorse{_GAP}or{_GAP}promote{_GAP}products{_GAP}derived{_GAP}from{_GAP}this{_GAP}software{_GAP}without{_GAP}specific{_GAP}prior{_GAP}written{_GAP}permission(?![a-z0-9])", "bsd.endorse"),
    *[(rf"(?<![a-z0-9])spdx{_GAP}license{_GAP}identifier{_GAP}(?:{_wide(x)})(?![a-z0-9])(?: [a-z0-9 ]*)?", f"{k}.spdx") for k, x in NAMES.items()],
    # the subject, and what follows the licence's name
    *[(rf"(?<![^\n]){_FREE}{_UNDER}(?:{_wide(x)}){_TAIL}(?![^\n])", f"{k}.notice") for k, x in NAMES.items()],
    *[(rf"(?<![a-z0-9])(?:https?{_GAP})?(?:www{_GAP})?(?:{_wide(x)})(?![a-z0-9])", f"{k}.url") for k, x in ADDRESSES.items()],
)
#: One of these is in every piece that holds a sentence with slots.
_SLOT_CUE = r"spdx|\bunder\b|endorse|https?\b|\borg\b"
#: The known sentences within a normalised piece: whole lines of it, the longest first; and markers.
FINDER = r"(?<![^\n])(" + "|".join(x.replace(" ", "[ \n]") for x in sorted(KNOWN, key=len, reverse=True)) + r")(?![^\n])|(@[a-z0-9.]+)"


def sentences(text: Column) -> Column:
    """Pieces of a text: cut after ``.;:!?`` before white space or the end (not after 'Inc.' and the like), and at lines
    without letters and digits. A piece may be a sentence wrapped over lines, with titles before it. The colon of an SPDX line does
    not cut, and its alternatives are lines of their own."""
    spdx = F.regexp_replace(text, r"(?i)(?<=SPDX-License-Identifier:[^\r\n]{0,200})\s+(?:OR|AND)\s+", "\n\nSPDX-License-Identifier: ")
    spdx = F.regexp_replace(spdx, r"(?i)(SPDX-License-Identifier):[ \t(]*", "\n\n$1 ")
    plain = F.when(text.rlike("(?i)SPDX-License-Identifier:"), spdx).otherwise(text)
    return F.split(plain, r"(?<!\b(?i:inc|corp|ltd|llc|co|univ)(?=\.))[.;:!?](?=\s|$)|(?:\r\n?+|\n)[^\p{L}\p{N}\r\n]*(?=[\r\n])")


def marked(piece: Column) -> Column:
    """A normalised piece with markers, on lines of their own, for its sentences with slots."""
    out = piece
    for pattern, name in SLOTTED:
        out = F.regexp_replace(out, pattern, f"\n@{name}\n")
    return F.when(piece.rlike(_SLOT_CUE), out).otherwise(piece)


def normalise(piece: Column) -> Column:
    """Lower-case words of a piece, with one space or line feed between them."""
    words = F.regexp_replace(F.lower(piece), r"[^a-z0-9\r\n]+", " ")
    return F.trim(F.regexp_replace(words, r" ?[\r\n][ \r\n]*", "\n"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids (identifiers in text order, joined by a space), licenses (names found,
    in rule order, joined by a comma), n_licenses.

    One row per row of ``docs`` (doc_id, text; other columns are ignored, repeated rows stay). Texts
    that are null, empty or without a known sentence have empty strings and 0. Whole texts are read.
    """
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    low = F.lower("text")
    cued = reduce(lambda a, b: a | b, [F.contains(low, F.lit(c)) for c in CUES])
    # only pieces that hold a cue are normalised
    told = F.filter(sentences(F.col("text")), lambda s: s.rlike(_CUED))
    found = F.flatten(F.transform(told, lambda s: F.regexp_extract_all(marked(normalise(s)), F.lit(FINDER), F.lit(0))))
    ids = F.transform(found, lambda s: F.when(s.startswith("@"), F.substring(s, 2, 40)).otherwise(F.element_at(known, F.replace(s, F.lit("\n"), F.lit(" ")))))
    out = docs.select("doc_id", F.when(cued, F.array_join(ids, " ")).otherwise("").alias("sentence_ids"))
    found, names = {}, []
    for name, family, rule in RULES:
        pattern = r"(^| )" + r"( .*)? ".join(x.replace(".", r"\.") for x in rule) + r"( |$)"
        holds = F.col("sentence_ids").rlike(pattern)
        earlier = found.get(family)
        names.append(F.when(holds if earlier is None else holds & ~earlier, F.lit(name)))
        found[family] = holds if earlier is None else earlier | holds
    out = out.withColumn("found", F.when(F.col("sentence_ids") != "", F.array_compact(F.array(*names))).otherwise(F.array().cast("array<string>")))
    return out.select(
        "doc_id",
        F.coalesce("sentence_ids", F.lit("")).alias("sentence_ids"),
        F.array_join("found", ",").alias("licenses"),
        F.size("found").alias("n_licenses"),
    )
