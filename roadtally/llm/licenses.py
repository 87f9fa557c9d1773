"""License scans: base phrases by words, and ordered signature rules over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadtally.llm.columns import let, narrow

# What separates words here, the base phrases and their labels.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
PHRASE_CONFIDENCE = 0.5

_GAP = r"[\s,.\-]+"
_VERSION = r"(?:\s*,?\s*v(?:ersion)?\.?)?\s*"

# Family: label, keyword (a word in lower case that must occur), pattern of the name, of the tag.
FAMILIES = [
    ("mit", "mit", r"(?:the\s+)?mit", r"mit-0"),
    ("mit", "expat", r"(?:the\s+)?expat", r"expat-licen[sc]e"),
    ("apache-2.0", "apache", r"apache(?:\s+software)?(?:\s+license)?" + _VERSION + r"2(?:\.0)?", r"apache-2\.0"),
    ("apache-1.1", "apache", r"apache(?:\s+software)?(?:\s+license)?" + _VERSION + r"1\.1", r"apache-1\.1"),
    ("bsd-2-clause", "bsd", r"(?:simplified|2-clause|two-clause)\s+bsd|bsd\s+2-clause", r"bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:new|modified|3-clause|three-clause)\s+bsd|bsd\s+3-clause", r"bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:original|4-clause|four-clause)\s+bsd|bsd\s+4-clause", r"bsd-4-clause"),
    ("0bsd", "0bsd", r"0bsd", r"0bsd"),
    ("0bsd", "bsd", r"zero-clause\s+bsd", r"bsd-zero-clause"),
    ("isc", "isc", r"isc", r"isc-licen[sc]e"),
    ("gpl-2.0", "gpl", r"(?:gnu\s+)?gpl" + _VERSION + r"2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?"),
    ("gpl-3.0", "gpl", r"(?:gnu\s+)?gpl" + _VERSION + r"3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?"),
    ("gpl-2.0", "general", r"(?:gnu\s+)?general\s+public\s+licen[sc]e" + _VERSION + r"2(?:\.0)?", r"gnu\s+gpl\s+2"),
    ("gpl-3.0", "general", r"(?:gnu\s+)?general\s+public\s+licen[sc]e" + _VERSION + r"3(?:\.0)?", r"gnu\s+gpl\s+3"),
    ("lgpl-2.1", "lgpl", r"(?:gnu\s+)?lgpl" + _VERSION + r"2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?"),
    ("lgpl-3.0", "lgpl", r"(?:gnu\s+)?lgpl" + _VERSION + r"3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e" + _VERSION + r"2\.1", r"gnu\s+lgpl\s+2"),
    ("lgpl-3.0", "lesser", r"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e" + _VERSION + r"3", r"gnu\s+lgpl\s+3"),
    ("agpl-3.0", "agpl", r"(?:gnu\s+)?agpl" + _VERSION + r"3(?:\.0)?", r"agpl-3\.0(?:-only|-or-later|\+)?"),
    ("agpl-3.0", "affero", r"(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e", r"gnu\s+affero\s+gpl"),
    ("gfdl-1.3", "documentation", r"(?:gnu\s+)?free\s+documentation\s+licen[sc]e", r"gfdl-1\.3"),
    ("mpl-1.1", "mpl", r"mpl" + _VERSION + r"1\.1", r"mpl-1\.1"),
    ("mpl-2.0", "mpl", r"mpl" + _VERSION + r"2(?:\.0)?", r"mpl-2\.0"),
    ("mpl-2.0", "mozilla", r"mozilla\s+public\s+licen[sc]e" + _VERSION + r"2(?:\.0)?", r"mozilla-2\.0"),
    ("epl-1.0", "eclipse", r"eclipse\s+public\s+licen[sc]e" + _VERSION + r"1(?:\.0)?", r"eclipse-1\.0"),
    ("epl-2.0", "eclipse", r"eclipse\s+public\s+licen[sc]e" + _VERSION + r"2(?:\.0)?", r"eclipse-2\.0"),
    ("cddl-1.0", "cddl", r"cddl", r"cddl-1\.0"),
    ("cddl-1.0", "development", r"common\s+development\s+and\s+distribution\s+licen[sc]e", r"cddl-licen[sc]e"),
    ("gpl-2.0", "gplv2", r"(?:gnu\s+)?gplv2", r"gplv2"),
    ("gpl-3.0", "gplv3", r"(?:gnu\s+)?gplv3", r"gplv3"),
    ("lgpl-3.0", "lgplv3", r"(?:gnu\s+)?lgplv3", r"lgplv3"),
    ("agpl-3.0", "agplv3", r"(?:gnu\s+)?agplv3", r"agplv3"),
    ("cpl-1.0", "common", r"common\s+public\s+licen[sc]e", r"cpl-1\.0"),
    ("eupl-1.2", "european", r"european\s+union\s+public\s+licen[sc]e", r"eupl-1\.2"),
    ("artistic-2.0", "artistic", r"artistic\s+licen[sc]e(?:" + _VERSION + r"2(?:\.0)?)?", r"artistic-2\.0"),
    ("bsl-1.0", "boost", r"boost(?:\s+software)?(?:\s+licen[sc]e)?" + _VERSION + r"1(?:\.0)?", r"bsl-1\.0"),
    ("unlicense", "unlicense", r"(?:the\s+)?unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?:/libpng)?", r"zlib-licen[sc]e"),
    ("openssl", "openssl", r"openssl", r"openssl-licen[sc]e"),
    ("postgresql", "postgresql", r"postgresql", r"postgresql-licen[sc]e"),
    ("python-2.0", "python", r"python\s+software\s+foundation", r"psf-2\.0"),
    ("ofl-1.1", "font", r"(?:sil\s+)?open\s+font\s+licen[sc]e", r"ofl-1\.1"),
    ("odbl-1.0", "database", r"open\s+database\s+licen[sc]e", r"odbl-1\.0"),
    ("cc0-1.0", "cc0", r"cc0(?:\s+1\.0)?", r"cc0-1\.0"),
    ("cc-by", "cc", r"cc" + _GAP + r"by(?![\s\-]+(?:nc|nd|sa)\b)", r"cc-by-[1-4]\.0"),
    ("cc-by-sa", "cc", r"cc" + _GAP + r"by" + _GAP + r"sa", r"cc-by-sa-[1-4]\.0"),
    ("cc-by-nc", "cc", r"cc" + _GAP + r"by" + _GAP + r"nc(?![\s\-]+(?:nd|sa)\b)", r"cc-by-nc-[1-4]\.0"),
    ("cc-by-nd", "cc", r"cc" + _GAP + r"by" + _GAP + r"nd", r"cc-by-nd-[1-4]\.0"),
    ("cc-by-nc-sa", "cc", r"cc" + _GAP + r"by" + _GAP + r"nc" + _GAP + r"sa", r"cc-by-nc-sa-[1-4]\.0"),
    ("cc-by-nc-nd", "cc", r"cc" + _GAP + r"by" + _GAP + r"nc" + _GAP + r"nd", r"cc-by-nc-nd-[1-4]\.0"),
    ("cc-by", "creative", r"creative\s+commons\s+attribution(?![\s\-]+(?:non|share|no))", r"creative\s+commons\s+by"),
    ("cc-by-sa", "creative", r"creative\s+commons\s+attribution[\s\-]+share[\s\-]*alike", r"creative\s+commons\s+by-sa"),
    ("cc-by-nc", "creative", r"creative\s+commons\s+attribution[\s\-]+non[\s\-]*commercial", r"creative\s+commons\s+by-nc"),
    ("proprietary", "proprietary", r"proprietary(?:\s+and\s+confidential)?", r"licenseref-proprietary"),
    ("public-domain", "domain", r"(?:the\s+)?public\s+domain", r"licenseref-public-domain"),
]

# Form: priority, confidence, word that must occur too, pattern around a name {n} or a tag {t}.
FORMS = [
    (5, 1.0, "spdx", r"spdx-license-identifier\s*:\s*(?:{t}|{n})"),
    (4, 0.95, "licensed", r"licensed\s+under\s+(?:the\s+terms\s+of\s+)?(?:the\s+|an?\s+)?(?:{n}|{t})(?:\s+licen[sc]e)?(?:\s+[1-4]\.0)?"),
    (4, 0.9, "under", r"(?:released|distributed|available|published|dual-licensed)\s+under\s+(?:the\s+terms\s+of\s+)?(?:the\s+|an?\s+)?(?:{n}|{t})(?:\s+licen[sc]e)?"),
    (3, 0.9, "license", r"license\s*[:=]\s*[\"']?(?:{t}|{n})"),
    (2, 0.8, "license", r"(?:{n})\s+license"),
    (2, 0.8, "licence", r"(?:{n})\s+licence"),
    (1, 0.6, "-", r"(?:{t})"),
]

# General notices: label, keyword, pattern; below every named license.
NOTICES = [
    ("reserved", "rights", r"all\s+rights\s+reserved"),
    ("copyright", "copyright", r"copyright\s+(?:\(c\)\s*|©\s*)?(?:19|20)[0-9]{2}"),
    ("copyright", "©", r"©\s+(?:19|20)[0-9]{2}"),
    ("gpl", "general", r"general\s+public\s+licen[sc]e"),
    ("license-file", "license", r"see\s+(?:the\s+)?licen[sc]e(?:\.txt|\.md|\s+file)"),
    ("no-warranty", "warranty", r"without\s+warranty\s+of\s+any\s+kind"),
    ("no-warranty", "warranties", r"without\s+warranties\s+of\s+any\s+kind"),
]

def signature_rules() -> list[tuple[str, list[tuple[int, str, int, float, str, str]]]]:
    """All rules, grouped by the keyword that lets them run: every family in every form."""
    groups: dict[str, list] = {}
    number = 0
    for label, keyword, name, tag in FAMILIES:
        for priority, confidence, also, form in FORMS:
            pattern = r"(?i)\b" + form.replace("{n}", name).replace("{t}", tag) + r"(?![0-9A-Za-z])"
            groups.setdefault(keyword, []).append((number, label, priority, confidence, also, pattern))
            number += 1
    for label, keyword, pattern in NOTICES:
        groups.setdefault(keyword, []).append((number, label, 0, 0.5, keyword, r"(?i)(?<![0-9A-Za-z])" + pattern))
        number += 1
    return list(groups.items())


def _constants(values: list, kind: str) -> Column:
    """An array the optimizer folds into one literal; an array of single literals takes longer."""
    return F.split(F.lit("\x01".join(map(str, values))), "\x01").cast(f"array<{kind}>")


_FOUND = "array<struct<start:int,behind:int,below:int,no:int,label:string,confidence:double>>"


def _detections(text: Column, parts: Column) -> Column:
    """Every match of every rule whose words occur among ``parts``, the words in lower case.

    ``behind`` and ``below`` are the end and the priority with the sign turned, so that a plain
    sort puts what contains before what is in it. A text without any keyword runs no rule.
    """
    groups = signature_rules()
    keywords = _constants([k for k, _ in groups], "string")
    begins = _constants([sum(len(r) for _, r in groups[:g]) for g in range(len(groups) + 1)], "int")
    fields = zip(*[rule for _, rules in groups for rule in rules])
    kinds = ("int", "string", "int", "double", "string", "string")
    number, label, priority, confidence, also, pattern = map(_constants, fields, kinds)
    wanted = _constants(sorted({k for k, _ in groups} | {r[4] for _, rules in groups for r in rules}), "string")

    def active(present: Column) -> Column:
        of_group = F.transform(
            F.filter(F.sequence(F.lit(0), F.lit(len(groups) - 1)), lambda g: F.array_contains(present, keywords[g])),
            lambda g: F.sequence(begins[g], begins[g + 1] - 1),
        )
        return F.filter(F.flatten(of_group), lambda r: (also[r] == "-") | F.array_contains(present, also[r]))

    def spans(rule: Column) -> Column:
        def walk(hits: Column, gaps: Column) -> Column:
            def step(state: Column, k: Column) -> Column:
                start = state["at"] + F.length(gaps[k])
                end = start + F.length(hits[k])
                found = F.struct(
                    start.alias("start"),
                    (-end).alias("behind"),
                    (-priority[rule]).alias("below"),
                    number[rule].alias("no"),
                    label[rule].alias("label"),
                    confidence[rule].alias("confidence"),
                )
                return F.struct(end.alias("at"), F.array_append(state["found"], found).alias("found"))

            begin = F.struct(F.lit(0).alias("at"), F.array().cast(_FOUND).alias("found"))
            return F.when(F.size(hits) == 0, F.array().cast(_FOUND)).otherwise(
                F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), begin, step, lambda s: s["found"])
            )

        return let(
            F.regexp_extract_all(text, pattern[rule], F.lit(0)),
            lambda hits: let(F.split(text, pattern[rule]), lambda gaps: walk(hits, gaps)),
        )

    def found(present: Column) -> Column:
        return F.when(F.size(present) == 0, F.array().cast(_FOUND)).otherwise(
            F.sort_array(F.flatten(F.transform(active(present), spans)))
        )

    return let(F.array_intersect(parts, wanted), found)


_LEVELS = range(6)


def _kept(found: Column) -> Column:
    """Drop a detection that lies inside one of the same or a higher priority; of equal intervals
    the first rule of the highest priority stays. One pass over the sorted detections."""

    def step(state: Column, d: Column) -> Column:
        end, level = -d["behind"], -d["below"]
        covering = [F.when(level <= p, state[f"end{p}"]).otherwise(-1) for p in _LEVELS]
        hidden = F.greatest(*covering) >= end
        ends = [
            F.when(level == p, F.greatest(state[f"end{p}"], end)).otherwise(state[f"end{p}"]).alias(f"end{p}")
            for p in _LEVELS
        ]
        return F.struct(*ends, F.when(hidden, state["kept"]).otherwise(F.array_append(state["kept"], d)).alias("kept"))

    begin = F.struct(*[F.lit(-1).alias(f"end{p}") for p in _LEVELS], F.array().cast(_FOUND).alias("kept"))
    return F.aggregate(found, begin, step, lambda s: s["kept"])


def scan_licenses(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """License labels of each text: ``id, n_words, phrases, detections, base_labels, labels, score``.

    ``phrases`` are (label, word): every place where the words of a base phrase stand one after
    the other, ASCII letters of either case. ``detections`` are the signature matches that no other
    one suppresses: (start, end, label, confidence), counted in characters from 0. ``score`` is the
    highest confidence of either kind, 0 without any. A null text counts as empty: no words, empty
    lists. Rows are independent: null or repeated ids come out as they are, other columns are
    ignored.
    """
    gate = "(?i)" + "|".join(p.replace(" ", SEPARATORS) for p in PHRASES)

    base = narrow(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    base = base.withColumn("_parts", F.split(F.lower("text"), SEPARATORS))

    none = F.array().cast("array<struct<label:string,word:int>>")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def places(all_words: Column) -> Column:
        def starts(parts: list[str], label: str) -> Column:
            def at(w: Column, i: Column) -> Column:
                same = w == parts[0]
                for k, part in enumerate(parts[1:], 1):
                    same = same & F.coalesce(F.get(all_words, i + k) == part, F.lit(False))
                return F.when(same, F.struct(F.lit(label).alias("label"), i.alias("word")))

            return F.filter(F.transform(all_words, at), lambda x: x.isNotNull())

        return F.concat(*[starts(p.split(" "), label) for p, label in PHRASES.items()])

    lowered = F.filter(F.split(F.translate("text", upper, lower), SEPARATORS), lambda w: w != "")
    found = _kept(_detections(F.col("text"), F.col("_parts")))
    out = base.select(
        "id",
        (
            F.size("_parts")
            - (F.col("_parts")[0] == "").cast("int")
            - ((F.size("_parts") > 1) & (F.element_at("_parts", -1) == "")).cast("int")
        ).cast("long").alias("n_words"),
        F.when(F.col("text").rlike(gate), let(lowered, places)).otherwise(none).alias("phrases"),
        F.transform(
            found,
            lambda d: F.struct(
                d["start"].alias("start"), (-d["behind"]).alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence")
            ),
        ).alias("detections"),
    )
    base_labels = F.array_sort(F.array_distinct(F.col("phrases.label")))
    return out.select(
        "*",
        base_labels.alias("base_labels"),
        F.array_sort(F.array_union(F.col("phrases.label"), F.col("detections.label"))).alias("labels"),
        F.greatest(
            F.when(F.size("phrases") > 0, PHRASE_CONFIDENCE).otherwise(0.0),
            F.coalesce(F.array_max("detections.confidence"), F.lit(0.0)),
        ).alias("score"),
    )
