"""Licence scans (native).

Method: a text is normalised to its words (ASCII letters lower-cased, every other ASCII character a separator). An
ordered table of signature rules, several hundred regexes, is gated twice: a text needs one of the ``GATES``, and a rule needs its
keyword in the text; both are parts of every string that the rule's regex matches, so they cost no match. The table has the base
phrases, SPDX identifiers, hand-written passages of notices and licence texts (``license_signatures``), and a few forms per licence
name. Only a rule for the later operands of an SPDX expression has a keyword that is a condition (``context``): the expression's
prefix. Each match is a word interval with the rule's priority. Overlaps are resolved by containment and priority: a detection goes if another one contains it and is
longer or ranks higher, or overlaps it partly with a higher priority.

All steps are in-row array expressions: nothing is shuffled and no Python runs.

Defined results: null, empty or blank text has no words, no detections and score 0; non-ASCII characters count as
letters; repeated rows are scanned alike; an empty table gives an empty result; other columns are passed through
``keep`` and never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgegraph.llm.license_signatures import CC_TERMS, CC_VERSIONS, SIGNATURES, SPDX_IDS
from edgegraph.llm.tables import lower_ascii

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

GATES = (" licen", " copyright", " copyleft", " spdx ", " gpl", " lgpl", " agpl", " cc by", " cc0", " public domain",
         " rights reserved", " creative commons", " apache", " bsd ", " wtfpl", " unlicense ", " permission ", " redistribution",
         " creativecommons org", " gnu org", " endorse or promote", " advertising", " good not evil", " openssl project", " mozilla org",
         " eclipse org", " boost org", " opendatacommons org", " under which a package", " beer in return", " implied warranty",
         " altered source versions", " unencumbered software", " neighboring rights", " terms and conditions",
         " contributor hereby", " unauthorized copying", " no part of this publication")

# label, keyword, name pattern, versions
FAMILIES = (
    ("gpl", "gnu general public", "gnu general public licen[sc]e", ("1.0", "2.0", "3.0")),
    ("lgpl", "lesser general public", "(?:gnu )?lesser general public licen[sc]e", ("2.0", "2.1", "3.0")),
    ("lgpl", "library general public", "(?:gnu )?library general public licen[sc]e", ("2.0",)),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e", ("1.0", "3.0")),
    ("gpl", " gpl", "(?:gnu )?gpl", ("1.0", "2.0", "3.0")),
    ("lgpl", " lgpl", "(?:gnu )?lgpl", ("2.0", "2.1", "3.0")),
    ("agpl", " agpl", "(?:gnu )?agpl", ("1.0", "3.0")),
    ("gfdl", "free documentation", "(?:gnu )?free documentation licen[sc]e", ("1.1", "1.2", "1.3")),
    ("apache", " apache", "apache(?: software)?(?: licen[sc]e)?", ("1.0", "1.1", "2.0")),
    ("mit", " mit ", "mit(?: x11)? licen[sc]e", ()),
    ("mit", " x11 ", "x11 licen[sc]e", ()),
    ("bsd", " bsd ", "bsd(?: licen[sc]e)?", ("0-clause", "2-clause", "3-clause", "4-clause")),
    ("isc", " isc ", "isc licen[sc]e", ()),
    ("mpl", "mozilla public", "mozilla public licen[sc]e", ("1.0", "1.1", "2.0")),
    ("epl", "eclipse public", "eclipse public licen[sc]e", ("1.0", "2.0")),
    ("cddl", "development and distribution", "common development and distribution licen[sc]e", ("1.0", "1.1")),
    ("cpl", "common public", "common public licen[sc]e", ("1.0",)),
    ("eupl", "european union public", "european union public licen[sc]e", ("1.1", "1.2")),
    ("artistic", " artistic ", "artistic licen[sc]e", ("1.0", "2.0")),
    ("bsl", " boost ", "boost software licen[sc]e", ("1.0",)),
    ("zlib", " zlib ", "zlib(?: libpng)? licen[sc]e", ()),
    ("ofl", "open font", "(?:sil )?open font licen[sc]e", ("1.0", "1.1")),
    ("odbl", "open database", "open (?:data commons open )?database licen[sc]e", ("1.0",)),
    ("odc-by", "data commons attribution", "open data commons attribution licen[sc]e", ("1.0",)),
    ("psf", "python software foundation", "python software foundation licen[sc]e", ("2.0",)),
    ("php", " php ", "php licen[sc]e", ("3.0", "3.01")),
    ("ruby", " ruby ", "ruby licen[sc]e", ()),
    ("wtfpl", " wtfpl", "wtfpl", ("2.0",)),
    ("unlicense", " unlicense ", "unlicense", ()),
    ("cc0", " cc0", "cc0(?: universal)?", ("1.0",)),
    ("cc-by", " cc by", "cc by", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", " cc by sa", "cc by sa", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", " cc by nc", "cc by nc", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", " cc by nd", "cc by nd", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", " cc by nc sa", "cc by nc sa", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", " cc by nc nd", "cc by nc nd", ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by", "commons attribution", "creative commons attribution(?: international| unported)?", ("2.0", "3.0", "4.0")),
    ("cc-by-sa", "attribution share", "creative commons attribution share ?alike(?: international| unported)?",
     ("2.0", "3.0", "4.0")),
    ("cc-by-nc", "attribution non", "creative commons attribution non ?commercial(?: international| unported)?",
     ("2.0", "3.0", "4.0")),
    ("cc-by-nd", "attribution no", "creative commons attribution no ?deriv(?:ative)?s(?: international| unported)?", ("2.0", "3.0", "4.0")),
    ("cc-by-nc-sa", "attribution non", "creative commons attribution non ?commercial share ?alike(?: international| unported)?",
     ("2.0", "3.0", "4.0")),
    ("cc-by-nc-nd", "attribution non", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: international| unported)?",
     ("2.0", "3.0", "4.0")),
    ("public-domain", " public domain", "(?:dedicated to|released into|in) the public domain", ()),
    ("proprietary", " rights reserved", "all rights reserved", ()),
)

# form -> (priority, text before the name, text after it)
FORMS = {
    "grant": (80, "(?:licensed|released|distributed|available|published) under (?:the terms of )?(?:the |an? )?", ""),
    "title": (60, "(?:the )?", "(?: licen[sc]e)?"),
}
BASE_PRIORITY = 40
SPDX_PRIORITY = 105  # the highest
PASSAGE_PRIORITY = 95
HEADER_PRIORITY = 70
SPDX_PREFIX = " spdx license identifier "


def _rule(label: str, kw: str, pattern: str, priority: int, base: bool = False, context: bool = False) -> dict:
    return {"kw": kw, "regex": f" {pattern}(?= )", "label": label, "priority": priority, "base": base, "context": context}


def rules() -> list[dict]:
    """The ordered signature table: base phrases, SPDX identifiers, passages, then per licence name every form with and without each
    version. ``context`` marks rules whose keyword is a condition of its own, not a part of their regex."""
    out = [_rule(label, f" {p} ", p, BASE_PRIORITY, base=True) for p, label in BASE_PHRASES.items()]
    every = "|".join(i for i, _ in SPDX_IDS)
    for i, label in SPDX_IDS:
        word = i.split("(")[0]
        out.append(_rule(label, f"{SPDX_PREFIX}{word}", f"spdx license identifier {i}", SPDX_PRIORITY))
        # an operand overlaps the one before it, so that neither contains the other
        out.append(_rule(label, SPDX_PREFIX, f"(?:{every}) (?:or|and) {i}", SPDX_PRIORITY, context=True))
        if any(c.isdigit() for c in word) or word in ("mit", "isc", "unlicense"):
            out.append(_rule(label, f" {word}", f"licen[sc]e(?: id| type| name)? {i}", HEADER_PRIORITY))
    out += [_rule(label, kw, pattern, PASSAGE_PRIORITY) for label, kw, pattern in SIGNATURES]
    for terms in CC_TERMS:
        label, address = f"cc-{terms.replace(' ', '-')}", f"creativecommons org licenses {terms}"
        out.append(_rule(label, f" {address}", address, PASSAGE_PRIORITY))
        out += [_rule(f"{label}-{v}", f" {address} {v.replace('.', ' ')}", f"{address} {v.replace('.', ' ')}", PASSAGE_PRIORITY)
                for v in CC_VERSIONS]
    for label, kw, name, versions in FAMILIES:
        for priority, before, after in FORMS.values():
            out.append(_rule(label, kw, f"{before}{name}{after}", priority))
            for v in versions:
                if v.endswith("-clause"):
                    n = v.split("-")[0]
                    named = f"(?:{n} clause {name}|{name} {n} clause(?: licen[sc]e)?)"
                else:
                    major, minor = v.split(".")
                    digits = f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}"
                    named = f"{name}{after}(?: version| v)? ?v?{digits}"
                out.append(_rule(f"{label}-{v}", kw, f"{before}{named}(?: only| or later)?", priority + 5))
    for i, r in enumerate(out):
        r["id"] = i
    return out


def normalise(text: Column) -> Column:
    """Words of the lower-cased text, each with one space before it, and a space at the end; ' ' if there are none."""
    s = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS, " ")
    s = F.trim(s)
    return F.when(s == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), s, F.lit(" ")))


def _rule_array(table: Sequence[dict]) -> Column:
    return F.array(*[F.struct(*[F.lit(r[k]).alias(k) for k in ("id", "kw", "regex", "label", "priority", "base")])
                     for r in table])


def scan(docs: DataFrame, keep: Sequence[str], table: Sequence[dict] | None = None,
         gates: Sequence[str] = GATES) -> DataFrame:
    """``keep`` columns, ``n_words`` and ``detections``: an array of (first, last, id, label, priority, base, kept) with
    word positions from 0 (bigint), all matches of all rules; ``kept`` marks those that survive the suppression."""
    def spaces(x: str) -> str:
        return f"(length({x}) - length(replace({x}, ' ', '')))"

    d = docs.select(*keep, normalise(F.col("text")).alias("_n"))
    gate = F.lit(False)
    for g in gates:
        gate = gate | F.contains(F.col("_n"), F.lit(g))
    d = d.withColumn("_r", F.when(gate, F.filter(_rule_array(table or rules()), lambda r: F.contains(F.col("_n"), r["kw"]))))
    # norm = piece, match, piece, ...: a match starts at the word whose number is the count of spaces before it
    d = d.withColumn("_m", F.expr(f"""
        flatten(transform(coalesce(_r, array()), r -> transform(aggregate(
            filter(zip_with(split(_n, r.regex, -1), regexp_extract_all(_n, r.regex, 0), (p, m) -> named_struct(
                'gap', {spaces('p')}, 'len', {spaces('m')})), x -> x.len IS NOT NULL),
            named_struct('at', 0, 'out', CAST(array() AS array<struct<first:int,last:int>>)),
            (a, x) -> named_struct('at', a.at + x.gap + x.len, 'out', concat(a.out, array(named_struct(
                'first', a.at + x.gap, 'last', a.at + x.gap + x.len - 1)))),
            a -> a.out), x -> named_struct('first', CAST(x.first AS bigint), 'last', CAST(x.last AS bigint), 'id', r.id,
                'label', r.label, 'priority', r.priority, 'base', r.base))))"""))
    longer = "(e.last - e.first > x.last - x.first)"
    higher = "(e.priority > x.priority OR (e.priority = x.priority AND e.id < x.id))"
    d = d.withColumn("detections", F.expr(f"""
        transform(_m, x -> named_struct('first', x.first, 'last', x.last, 'id', x.id, 'label', x.label,
            'priority', x.priority, 'base', x.base, 'kept', NOT exists(_m, e ->
                (e.first <= x.first AND e.last >= x.last AND ({longer} OR (e.last = x.last AND e.first = x.first AND {higher})))
                OR (e.first <= x.last AND e.last >= x.first AND NOT (e.first >= x.first AND e.last <= x.last)
                    AND e.priority > x.priority))))"""))
    n_words = F.expr(f"greatest({spaces('_n')} - 1, 0)").cast("bigint")
    return d.select(*keep, n_words.alias("n_words"), "detections")


def summarise(found: DataFrame, keep: Sequence[str]) -> DataFrame:
    """n_base, first_word, last_word, base_labels, labels and score (priority of the best kept detection over the
    highest priority there is) of :func:`scan`'s rows."""
    top = float(SPDX_PRIORITY)
    base = "filter(detections, x -> x.base)"
    return found.select(
        *keep, "n_words", F.expr(f"CAST(size({base}) AS bigint)").alias("n_base"),
        F.expr(f"array_min(transform({base}, x -> x.first))").alias("first_word"),
        F.expr(f"array_max(transform({base}, x -> x.first))").alias("last_word"),
        F.expr(f"array_join(array_sort(array_distinct(transform({base}, x -> x.label))), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(transform(filter(detections, x -> x.base OR x.kept), "
               "x -> x.label))), ',')").alias("labels"),
        F.expr(f"CAST(coalesce(array_max(transform(filter(detections, x -> x.kept), x -> x.priority)), 0) / {top} "
               "AS double)").alias("score"))
