"""License detections by ordered signature rules.

Rules are regular expressions with a keyword each. A text is searched by a rule only if it
has the rule's keyword. Detections that lie inside another one are dropped; of two that
overlap the one of the earlier rule stays. Everything happens inside a document's row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import whole

#: Characters of words; all others separate words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose words are searched as such, and their labels. Fixed values.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Licences: label, telling word, name, identifier, address. Patterns are matched on lower-case
#: text, where ``_`` stands for a gap of up to three non-word characters. A rule is gated by the
#: telling word only if its own pattern has it; see ``_keyword``.
LICENSES = [
    ("agpl", "affero", r"(gnu_)?affero_general_public_licen[cs]e", r"agpl_?v?[123](\.0)?(_only|_or_later|\+)?", r"gnu\.org/licenses/agpl"),
    ("lgpl", "lesser", r"(gnu_)?lesser_general_public_licen[cs]e", r"lgpl_?v?[23](\.[01])?(_only|_or_later|\+)?", r"gnu\.org/licenses/lgpl"),
    ("lgpl", "library", r"(gnu_)?library_general_public_licen[cs]e", r"lgpl_2(\.0)?_only", r"gnu\.org/licenses/old_licenses/lgpl"),
    ("gpl", "gnu", r"gnu_general_public_licen[cs]e", r"gnu_gpl(_?v?[123](\.0)?)?", r"gnu\.org/licenses/gpl"),
    ("gpl", "gpl", r"gpl_licen[cs]e", r"gpl_?v?[123](\.0)?(_only|_or_later|\+)?", r"opensource\.org/licenses/gpl"),
    ("gfdl", "documentation", r"(gnu_)?free_documentation_licen[cs]e", r"gfdl_1\.[123]", r"gnu\.org/licenses/fdl"),
    ("apache", "apache", r"apache_licen[cs]e", r"apache_[12]\.[01]", r"apache\.org/licenses"),
    ("mit", "mit", r"mit_licen[cs]e", r"mit", r"opensource\.org/licenses/mit"),
    ("mit-0", "mit", r"mit_no_attribution_licen[cs]e", r"mit_0", r"opensource\.org/licenses/mit_0"),
    ("expat", "expat", r"expat_licen[cs]e", r"expat", r"expat\.sourceforge"),
    ("bsd-2-clause", "bsd", r"(simplified|2_clause|two_clause)_bsd_licen[cs]e", r"bsd_2_clause", r"opensource\.org/licenses/bsd_2_clause"),
    ("bsd-3-clause", "bsd", r"(new|revised|modified|3_clause|three_clause)_bsd_licen[cs]e", r"bsd_3_clause", r"opensource\.org/licenses/bsd_3_clause"),
    ("bsd-4-clause", "bsd", r"(original|4_clause|four_clause)_bsd_licen[cs]e", r"bsd_4_clause", r"directory\.fsf\.org/wiki/license:bsd_4"),
    ("bsd", "bsd", r"bsd_licen[cs]e", r"bsd", r"opensource\.org/licenses/bsd_license"),
    ("isc", "isc", r"isc_licen[cs]e", r"isc", r"opensource\.org/licenses/isc"),
    ("zlib", "zlib", r"zlib(_libpng)?_licen[cs]e", r"zlib", r"opensource\.org/licenses/zlib"),
    ("mpl", "mozilla", r"mozilla_public_licen[cs]e", r"mpl_[12]\.[01]_no_copyleft_exception", r"mozilla\.org/mpl"),
    ("mpl", "mpl", r"mpl_licen[cs]e", r"mpl_[12]\.[01]", r"mozilla\.org/en_us/mpl"),
    ("epl", "epl", r"eclipse_public_licen[cs]e", r"epl_[12]\.0", r"eclipse\.org/legal/epl"),
    ("edl", "edl", r"eclipse_distribution_licen[cs]e", r"edl_1\.0", r"eclipse\.org/org/documents/edl"),
    ("cddl", "cddl", r"cddl_licen[cs]e", r"cddl_1\.[01]", r"opensource\.org/licenses/cddl"),
    ("cddl", "development", r"common_development_and_distribution_licen[cs]e", r"cddl_?v?1(\.[01])?", r"netbeans\.org/cddl"),
    ("cpl", "cpl", r"common_public_licen[cs]e", r"cpl_1\.0", r"opensource\.org/licenses/cpl"),
    ("cpal", "attribution", r"common_public_attribution_licen[cs]e", r"cpal_1\.0", r"opensource\.org/licenses/cpal"),
    ("eupl", "eupl", r"eupl_licen[cs]e", r"eupl_1\.[012]", r"joinup\.ec\.europa\.eu/.{0,40}eupl"),
    ("eupl", "european", r"european_union_public_licen[cs]e", r"eupl_?v1\.[012]", r"eur_lex\.europa\.eu/.{0,40}licen[cs]e"),
    ("artistic", "artistic", r"artistic_licen[cs]e", r"artistic_[12]\.0", r"opensource\.org/licenses/artistic"),
    ("bsl", "boost", r"boost_software_licen[cs]e", r"bsl_1\.0", r"boost\.org/license"),
    ("busl", "business", r"business_source_licen[cs]e", r"busl_1\.1", r"mariadb\.com/bsl"),
    ("sspl", "server", r"server_side_public_licen[cs]e", r"sspl_1\.0", r"mongodb\.com/licensing/server"),
    ("elastic", "elastic", r"elastic_licen[cs]e", r"elastic_2\.0", r"elastic\.co/licensing"),
    ("unlicense", "unlicense", r"the_unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "wtfpl", r"wtfpl_licen[cs]e", r"wtfpl(_v?2)?", r"wtfpl\.net"),
    ("cc0", "cc0", r"cc0(_1\.0)?(_universal)?", r"cc0_1\.0", r"creativecommons\.org/publicdomain/zero"),
    ("cc-by-nc-nd", "nc", r"creative_commons_attribution_non_?commercial_no_?deriv\w+", r"cc_by_nc_nd(_[1-4]\.[05])?", r"creativecommons\.org/licenses/by_nc_nd"),
    ("cc-by-nc-sa", "nc", r"creative_commons_attribution_non_?commercial_share_?alike", r"cc_by_nc_sa(_[1-4]\.[05])?", r"creativecommons\.org/licenses/by_nc_sa"),
    ("cc-by-nc", "nc", r"creative_commons_attribution_non_?commercial", r"cc_by_nc(_[1-4]\.[05])?", r"creativecommons\.org/licenses/by_nc"),
    ("cc-by-nd", "nd", r"creative_commons_attribution_no_?deriv\w+", r"cc_by_nd(_[1-4]\.[05])?", r"creativecommons\.org/licenses/by_nd"),
    ("cc-by-sa", "sa", r"creative_commons_attribution_share_?alike", r"cc_by_sa(_[1-4]\.[05])?", r"creativecommons\.org/licenses/by_sa"),
    ("cc-by", "by", r"creative_commons_attribution(_licen[cs]e|_[1-4])", r"cc_by(_[1-4]\.[05])?", r"creativecommons\.org/licenses/by/"),
    ("public-domain", "domain", r"(in|into)_the_public_domain", r"public_domain_dedication", r"creativecommons\.org/.{0,20}public_?domain"),
    ("psf", "python", r"python_software_foundation_licen[cs]e", r"python_2\.0(\.1)?", r"python\.org/.{0,20}license"),
    ("php", "php", r"php_licen[cs]e", r"php_3\.0[01]?", r"php\.net/license"),
    ("ruby", "ruby", r"ruby_licen[cs]e", r"ruby", r"ruby_lang\.org/.{0,20}license"),
    ("postgresql", "postgresql", r"postgresql_licen[cs]e", r"postgresql", r"postgresql\.org/about/licen[cs]e"),
    ("openssl", "openssl", r"openssl_licen[cs]e", r"openssl", r"openssl\.org/source/license"),
    ("odbl", "odbl", r"odbl_licen[cs]e", r"odbl_1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("odbl", "database", r"open_database_licen[cs]e", r"open_data_commons_open_database", r"opendatacommons\.org/licenses/dbcl"),
    ("ofl", "font", r"(sil_)?open_font_licen[cs]e", r"sil_open_font", r"scripts\.sil\.org/ofl"),
    ("ofl", "ofl", r"ofl_licen[cs]e", r"ofl_1\.[01]", r"openfontlicense\.org"),
    ("ms-pl", "microsoft", r"microsoft_public_licen[cs]e", r"ms_pl", r"opensource\.org/licenses/ms_pl"),
    ("ms-rl", "microsoft", r"microsoft_reciprocal_licen[cs]e", r"ms_rl", r"opensource\.org/licenses/ms_rl"),
    ("afl", "afl", r"academic_free_licen[cs]e", r"afl_(1\.[12]|2\.[01]|3\.0)", r"opensource\.org/licenses/afl"),
    ("osl", "osl", r"open_software_licen[cs]e", r"osl_(1\.[01]|2\.[01]|3\.0)", r"opensource\.org/licenses/osl"),
    ("qpl", "qpl", r"q_public_licen[cs]e", r"qpl_1\.0", r"opensource\.org/licenses/qtpl"),
    ("lppl", "lppl", r"latex_project_public_licen[cs]e", r"lppl_1\.[0-3][ac]?", r"latex_project\.org/lppl"),
    ("openrail", "rail", r"(big)?(open|code|science)_?(open)?_?rail(_m)?_licen[cs]e", r"openrail(_m)?", r"huggingface\.co/.{0,40}rail"),
    ("proprietary", "reserved", r"all_rights_reserved", r"proprietary", r"rights_reserved_worldwide"),
]

#: Identifiers that are words of other senses: they count only behind ``SPDX-License-Identifier`` or "licensed under".
WORDS_TOO = ("mit", "expat", "bsd", "isc", "zlib", "unlicense", "ruby", "postgresql", "openssl", "psf", "proprietary", "elastic", "artistic", "bsl")

#: Sentences by which the texts of licences and their notices are known, with the literal that gates each: label,
#: literal, pattern. Fixed values, quoted from the licences.
SENTENCES = [
    ("agpl", "affero", r"redistribute_it_and_or_modify_it_under_the_terms_of_the_(gnu_)?affero_general_public_licen[cs]e"),
    ("lgpl", "lesser", r"redistribute_it_and_or_modify_it_under_the_terms_of_the_(gnu_)?lesser_general_public_licen[cs]e"),
    ("gpl", "redistribute", r"redistribute_it_and_or_modify_it_under_the_terms_of_the_gnu_general_public_licen[cs]e"),
    ("bsl", "accompanying", r"any_person_or_organization_obtaining_a_copy_of_the_software_and_accompanying_documentation"),
    ("mit", "hereby", r"permission_is_hereby_granted_free_of_charge_to_any_person_obtaining_a_copy"),
    ("bsd", "redistribution", r"redistribution_and_use_in_source_and_binary_forms"),
    ("bsd-3-clause", "endorse", r"may_be_used_to_endorse_or_promote_products_derived_from_this_software"),
    ("bsd-4-clause", "advertising", r"all_advertising_materials_mentioning_features_or_use_of_this_software"),
    ("isc", "distribute", r"permission_to_use_copy_modify_(and_or_|and_)?distribute_this_software_for_any_purpose_with_or_without_fee"),
    ("zlib", "misrepresented", r"the_origin_of_this_software_must_not_be_misrepresented"),
    ("mpl", "mozilla", r"this_source_code_form_is_subject_to_the_terms_of_the_mozilla_public_licen[cs]e"),
    ("unlicense", "unencumbered", r"this_is_free_and_unencumbered_software"),
    ("cc0", "deed", r"the_person_who_associated_a_work_with_this_deed_has_dedicated_the_work"),
    ("cc0", "reserved", r"no_rights_reserved"),
    ("postgresql", "agreement", r"without_fee_and_without_a_written_agreement_is_hereby_granted"),
    ("mit", "apache", r"mit(?=_or_apache_2\.0)"),
    ("mit", "apache", r"(?<=apache[^a-z0-9]2\.0[^a-z0-9]or[^a-z0-9])mit"),
]

#: Sentence forms around a name, from the most to the least telling, with their confidence.
FORMS = [
    (r"(licen[cs]ed|released|distributed|available|published)_under_(the_)?(terms_of_)?(the_)?(%s)(_?,?_?version_?[0-9.]*[0-9]|_?v?[0-9]\.[0-9])?", "name", 1.0),
    (r"spdx_license_identifier_?:?_?(%s)", "id", 1.0),
    (r"(licen[cs]ed|released|distributed|available|published)_under_(the_)?(terms_of_)?(the_)?(%s)", "id", 0.9),
    (r"(%s)(_?,?_?version_?[0-9.]*[0-9]|_?v?[0-9]\.[0-9])", "name", 0.9),
    (r"(%s)", "url", 0.9),
    (r"(%s)", "name", 0.8),
    (r"(%s)", "id", 0.7),
]


#: Literals that tell nothing.
_COMMON = ("licen", "license", "licenses", "public", "only", "general", "open")


@dataclass(frozen=True)
class Rule:
    """One signature. A smaller ``priority`` wins over a larger one."""

    priority: int
    label: str
    keyword: str
    pattern: str
    confidence: float


def _literals(pattern: str) -> list[str]:
    """Pieces of text that every match of a pattern has, groups left aside."""
    while (shorter := re.sub(r"\([^()]*\)\??", "_", pattern)) != pattern:
        pattern = shorter
    plain = re.sub(r"\[[^]]*\]|\\w\+|\.\{[^}]*\}|\w\?", "_", pattern).replace("\\.", ".")
    return [r for r in re.split("[^a-z0-9./:]+", plain) if r]


def _keyword(pattern: str, word: str) -> str:
    """A literal of the pattern: the longest that has ``word``, else the longest that is not a common one."""
    own = _literals(pattern)
    return max([r for r in own if word in r] or [r for r in own if r not in _COMMON], key=len)


def _spread(body: str) -> str:
    """The pattern of whole words, with gaps in place of ``_``."""
    spread = body.replace("_", r"[^a-z0-9]{1,3}").replace(r"[^a-z0-9]{1,3}?", r"[^a-z0-9]{0,3}")
    return rf"(?<![a-z0-9]){spread}(?![a-z0-9])"


def signature_rules() -> list[Rule]:
    """All rules in order: sentences of licences, then by form of notice and by licence."""
    rules = [Rule(i, label, keyword, _spread(body), 1.0) for i, (label, keyword, body) in enumerate(SENTENCES)]
    for form, part, confidence in FORMS:
        for label, keyword, name, identifier, address in LICENSES:
            if part == "id" and form == "(%s)" and identifier in WORDS_TOO or label == "psf" and form == "(%s)" and part == "id":
                continue
            own = {"name": name, "id": identifier, "url": address}[part]
            rules.append(Rule(len(rules), label, _keyword(own, keyword), _spread(form % own), confidence))
    return rules


def _gate(rules: list[Rule]) -> str:
    """One pattern that finds nothing in a text which no rule can match: a common word of notices.

    It is tried where words begin only, as each rule's words do.
    """
    words = r"licen[cs]e|(ruby|eur)[^a-z0-9]{1,3}le?[ax]|(released|distributed|available|published)[^a-z0-9]{1,3}under|hereby[^a-z0-9]{1,3}granted|redistribut|obtaining|endorse|advertising|permission|misrepresented|unencumbered|deed|apache[^a-z0-9]2\.0|(?<![a-z])((cc|ms|lppl|afl|osl|qpl|cpl|epl|edl)[^a-z0-9]{1,3}[0-9pr]|(agpl|lgpl|gpl|cddl|eupl)v?[0-9])|database|reserved|rights|domain|unlicense|wtfpl|cc0|cc[^a-z0-9]{1,3}by|creative|openrail|(?<![a-z])(gnu|gpl|lgpl|agpl|gfdl|mit|mpl|apache|bsd|bsl|busl|sspl|cddl|cpal|eupl|epl|artistic|ofl|odbl|elastic|sil|openssl|eclipse|microsoft|latex|open|python|zlib|php)[^a-z0-9]{1,3}(or|gpl|v?[0-9]|edl|epl|open|commons|project|lppl|ms|ssleay|acknowledgement)|(opensource|gnu|apache|mozilla|eclipse|netbeans|joinup|eur.lex|boost|mariadb|mongodb|elastic|creativecommons|python|php|ruby.lang|postgresql|openssl|opendatacommons|sil|openfontlicense|sourceforge|latex.project|huggingface|fsf)\.(org|net|com|co|ec)|expat\.sourceforge|(?<![a-z0-9])gpl[^a-z0-9]{0,3}v?[123]"
    return rf"(?<![a-z0-9])(?:{words})"


def _spans(text: Column, pattern: Column, rule: Column) -> Column:
    """Detections of one pattern in order, as structs; ``text`` must be a column name's value."""
    none = F.array().cast("array<struct<start:int,end:int,no:int>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["before"])
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), rule.alias("no"))
        return F.struct(
            F.coalesce(end, begin).alias("at"),
            F.when(x["match"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(span))).alias("out"),
        )

    def placed(found: Column) -> Column:
        both = F.arrays_zip(F.split(text, pattern, -1).alias("before"), found.alias("match"))
        return F.aggregate(both, start, step, lambda state: state["out"])

    # Most rules whose keyword occurs find nothing; only for the others is the text cut.
    once = F.array(F.regexp_extract_all(text, pattern, F.lit(0)))
    return F.flatten(F.transform(once, lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(none)))


def _suppress(sorted_spans: Column) -> Column:
    """Spans sorted by start, longest first, rule: drop the contained, resolve overlaps by rule."""
    none = F.array().cast("array<struct<start:int,end:int,no:int>>")

    def step(kept: Column, x: Column) -> Column:
        last = F.element_at(kept, -1)
        span = F.struct(x["start"].alias("start"), (-x["minus_end"]).alias("end"), x["no"].alias("no"))
        return (
            F.when(F.size(kept) == 0, F.array(span))
            .when(span["end"] <= last["end"], kept)
            .when(span["start"] >= last["end"], F.concat(kept, F.array(span)))
            .when(span["no"] < last["no"], F.concat(F.slice(kept, 1, F.size(kept) - 1), F.array(span)))
            .otherwise(kept)
        )

    return F.aggregate(sorted_spans, none, step)


def scan_licenses(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """License phrases and detections of every text.

    Returns the columns in ``keep`` (which must not be named as a result), ``n_words``,
    ``n_base``, ``first_word``, ``last_word``, ``base_labels`` (array), ``detections`` (array
    of ``start``, ``end`` in code points, ``label``, ``confidence``), ``labels`` (array) and
    ``score``, the greatest confidence (1 for a base phrase, 0 without any detection). A NULL
    or empty text has no words and no detection. Repeated rows are scanned each.
    """
    rules = signature_rules()
    table = F.array(
        *[F.struct(F.lit(r.priority).alias("no"), F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern")) for r in rules]
    )
    labels = F.array(*[F.lit(r.label) for r in rules])
    confidence = F.array(*[F.lit(r.confidence) for r in rules])
    base = r"(?<!W)(P)(?!W)".replace("W", WORD).replace("P", "|".join(p.replace(" ", GAP) for p in BASE_PHRASES))

    def count(value: Column) -> Column:
        return F.regexp_count(value, F.lit(WORD + "+"))

    df = docs.select(*keep, F.lower(whole(text)).alias("__low"))
    df = df.select(
        "*",
        count(F.col("__low")).cast("long").alias("n_words"),
        F.when(F.col("__low").rlike(base), F.regexp_extract_all("__low", F.lit(base), 0)).alias("__base"),
        F.when(F.col("__low").rlike(_gate(rules)), F.filter(table, lambda r: F.contains(F.col("__low"), r["keyword"]))).alias("__rules"),
    )
    spans = F.flatten(F.transform("__rules", lambda r: _spans(F.col("__low"), r["pattern"], r["no"])))
    ordered = F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["no"].alias("no")))
    )
    df = df.select("*", _suppress(ordered).alias("__spans"), F.when(F.col("__base").isNotNull(), F.split("__low", base, -1)).alias("__pieces"))
    of_phrase = F.create_map(*[F.lit(x) for pair in BASE_PHRASES.items() for x in pair])
    base_labels = F.array_sort(
        F.array_distinct(F.transform("__base", lambda m: of_phrase[F.regexp_replace(m, GAP, " ")]))
    )
    no_strings = F.array().cast("array<string>")
    df = df.select(
        *keep,
        "n_words",
        F.when(F.col("__base").isNull(), 0).otherwise(F.size("__base")).cast("long").alias("n_base"),
        F.when(F.col("__base").isNotNull(), count(F.get("__pieces", F.lit(0)))).cast("long").alias("first_word"),
        F.when(
            F.col("__base").isNotNull(),
            F.col("n_words") - count(F.element_at("__pieces", -1)) - count(F.element_at("__base", -1)),
        ).cast("long").alias("last_word"),
        F.coalesce(base_labels, no_strings).alias("base_labels"),
        F.coalesce(
            F.transform(
                "__spans",
                lambda s: F.struct(
                    s["start"].alias("start"),
                    s["end"].alias("end"),
                    F.get(labels, s["no"]).alias("label"),
                    F.get(confidence, s["no"]).alias("confidence"),
                ),
            ),
            F.array().cast("array<struct<start:int,end:int,label:string,confidence:double>>"),
        ).alias("detections"),
    )
    return df.select(
        "*",
        F.array_sort(F.array_union("base_labels", F.transform("detections", lambda d: d["label"]))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)))
        .alias("score"),
    )
