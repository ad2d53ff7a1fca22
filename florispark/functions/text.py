"""Record transforms as pure Column functions; nothing here leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values of the domain
CAS_PLACEHOLDER = "999999-99-4"
RANK_MARKERS = ("var", "subsp", "ssp", "f", "cv")
ANNEXES = ("VIII", "VII", "III", "VI", "IV", "II", "V", "I")
ANNEX_LABELS = {"II": "II (Prohibited)", "III": "III (Restricted)", "IV": "IV (Colorants)", "V": "V (Preservatives)", "VI": "VI (UV filters)"}


def strip_ws(c: Column) -> Column:
    """Trim with all Unicode white space, no-break space included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip_ws(c), F.lit(""))


def distinct_in_order(c: Column) -> Column:
    return F.array_distinct(c)


def split_list(c: Column, pattern: str = ",") -> Column:
    """Stripped items of a delimited list without blanks."""
    return F.filter(F.transform(F.split(c, pattern), strip_ws), lambda x: x != "")


def join_list(c: Column, sep: str = " | ") -> Column:
    """Items joined for a cell; null and blank ones are skipped."""
    return F.array_join(F.filter(F.array_compact(c), lambda x: x != ""), sep)


def split_cas(c: Column) -> Column:
    """struct(numbers, primary, is_generic, leftover) of a raw registry-number field."""
    text = F.coalesce(strip_ws(c), F.lit(""))
    generic = text.rlike(r"(?i)\(\s*generic\s*\)")
    closed = F.regexp_replace(F.regexp_replace(text, r"(?i)\(\s*generic\s*\)", " "), r"(\d)\s*-\s*(?=\d)", "$1-")
    found = F.array_distinct(F.array_remove(F.regexp_extract_all(closed, F.lit(r"(\d{2,7}-\d{2}-\d)"), 1), CAS_PLACEHOLDER))
    rest = strip_ws(F.regexp_replace(F.regexp_replace(closed, r"\d{2,7}-\d{2}-\d", ""), r"(?U)[;,/\s]+", " "))
    return F.struct(found.alias("numbers"), F.try_element_at(found, F.lit(1)).alias("primary"), generic.alias("is_generic"), F.nullif(rest, F.lit("")).alias("leftover"))


def norm_name(c: Column) -> Column:
    """Organism name without hybrid signs and rank markers, single-spaced and in lower case."""
    text = F.regexp_replace(c, "×", " ")
    text = F.regexp_replace(text, r"(?i)(?<=^|\s)x(?=\s|$)", " ")
    text = F.regexp_replace(text, rf"(?i)(?<=^|\s)({'|'.join(RANK_MARKERS)})\.(?=\s|$)", " ")
    return F.lower(strip_ws(F.regexp_replace(text, r"(?U)\s+", " ")))


def first_words(c: Column, n: int) -> Column:
    return F.substring_index(c, " ", n)


def word_count(c: Column) -> Column:
    return F.when(c == "", 0).otherwise(F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1)


def tokens(c: Column, prefixes: Sequence[str] = ()) -> Column:
    """Upper-case tokens of a trade name without dots; leading process words are dropped."""
    words = F.filter(F.transform(F.split(F.upper(c), r"[\s/,]+"), lambda x: F.replace(x, F.lit("."), F.lit(""))), lambda x: x != "")
    if not prefixes:
        return words
    known = F.array(*map(F.lit, prefixes))
    lead = F.array_position(F.transform(words, lambda x: F.array_contains(known, x)), False).cast("int")
    return F.when(lead > 0, F.slice(words, lead, F.size(words))).otherwise(F.array().cast("array<string>"))


def binomial(words: Column, not_genus: Sequence[str] = (), not_epithet: Sequence[str] = ()) -> Column:
    """struct(genus, epithet) of the first two tokens, null where they can't be a name."""
    genus, epithet = F.get(words, 0), F.get(words, 1)
    alpha = lambda x: F.regexp_replace(x, "-", "").rlike(r"^\p{L}+$")
    ok = (F.size(words) >= 2) & alpha(genus) & alpha(epithet) & ~genus.isin(*not_genus or [""]) & ~epithet.isin(*not_epithet or [""])
    return F.when(ok, F.struct(F.initcap(genus).alias("genus"), F.lower(epithet).alias("epithet")))


# fixed values: family names that don't end as the others do
CONSERVED_FAMILIES = ("Leguminosae", "Labiatae", "Compositae", "Umbelliferae", "Gramineae", "Guttiferae", "Palmae", "Cruciferae")
FAMILY = r"(?:\p{Lu}\p{Ll}+aceae|" + "|".join(CONSERVED_FAMILIES) + ")"


def description_candidates(c: Column, family_pattern: str = FAMILY, noise: Sequence[str] = ()) -> Column:
    """struct(family, candidates): the last family word, and 'Genus epithet' pairs before it."""
    families = F.regexp_extract_all(c, F.lit(f"({family_pattern})"), 1)
    family = F.when(F.size(families) > 0, F.element_at(families, -1))
    cleaned = F.regexp_replace(F.regexp_replace(c, r"\(syn\.[^)]*\)", " "), r"\bsyn\.[^,;]*$", " ")
    # all that stands before the last family word
    head = F.when(family.isNull(), cleaned).otherwise(F.regexp_replace(cleaned, rf"(?s)({family_pattern})(?!.*{family_pattern}).*$", ""))
    pattern = F.lit(r"(\p{Lu}\p{Ll}+)\s+([a-z][a-z-]+)")
    pairs = F.arrays_zip(F.regexp_extract_all(head, pattern, 1).alias("genus"), F.regexp_extract_all(head, pattern, 2).alias("epithet"))
    return F.struct(family.alias("family"), F.filter(pairs, lambda x: ~x["genus"].isin(*noise or [""])).alias("candidates"))


def pick_candidate(candidates: Column, genus: Column) -> Column:
    """From the end: the same genus, else one within two edits, else the last."""
    back = F.reverse(candidates)
    same = F.filter(back, lambda x: x["genus"] == genus)
    near = F.filter(back, lambda x: F.levenshtein(x["genus"], genus) <= 2)
    return F.coalesce(F.try_element_at(same, F.lit(1)), F.try_element_at(near, F.lit(1)), F.try_element_at(back, F.lit(1)))


def disagreement(ig: Column, ie: Column, dg: Column, de: Column) -> Column:
    """The kind of difference between the name's and the description's binomial, first rule that holds."""
    flat = lambda x: F.regexp_replace(x, "[- ]", "")
    return (
        F.when((ig == dg) & (ie == de), "agree")
        .when(de.isNull(), "desc_unparsed")
        .when(ie.isin("spp", "sp"), "genus_level_entry")
        .when(ig.isNull() | ie.isNull(), "inci_not_binomial")
        .when((de == "x") | (ie == "x"), "hybrid")
        .when((ig == dg) & (flat(ie) == flat(de)), "hyphen_split")
        .when((ig == dg) & (F.startswith(flat(de), flat(ie)) | F.startswith(de, F.concat(ie, F.lit("-")))), "inci_truncated")
        .when((F.levenshtein(F.concat_ws(" ", ig, ie), F.concat_ws(" ", dg, de)) == 1), "spelling_variant")
        .when(ig == dg, "species_mismatch")
        .otherwise("genus_mismatch")
    )


def citations(c: Column) -> Column:
    """array<struct(annex, ref)> of every 'ROMAN/number' in a text, in order."""
    pattern = F.lit(rf"(?i)(?:annex\s+)?\b({'|'.join(ANNEXES)})\s*/\s*(\d+[a-z]?)")
    return F.transform(F.arrays_zip(F.regexp_extract_all(c, pattern, 1).alias("a"), F.regexp_extract_all(c, pattern, 2).alias("r")), lambda x: F.struct(F.upper(x["a"]).alias("annex"), x["r"].alias("ref")))


def cmr_class(c: Column) -> Column:
    """1A, 1B or 2 from either spelling, null without one."""
    pattern = r"(?i)\bCMR\s*(1A|1B|2)\b|\b(?:Carc|Muta|Repr)\.?\s*(1A|1B|2)\b"
    return F.upper(F.nullif(F.concat(F.regexp_extract(c, pattern, 1), F.regexp_extract(c, pattern, 2)), F.lit("")))


def restriction_prefix(c: Column) -> Column:
    return F.when(c.rlike("^[IVX]+/"), F.regexp_extract(c, "^([IVX]+)/", 1)).otherwise("other")


def regulation_parts(c: Column) -> Column:
    """struct(annex, entry) of a short 'ANNEX/entry'; labels where known."""
    annex, ok = F.split_part(c, F.lit("/"), F.lit(1)), F.contains(c, F.lit("/")) & (F.length(c) < 20)
    label = F.coalesce(F.create_map(*[F.lit(x) for kv in ANNEX_LABELS.items() for x in kv])[annex], annex)
    return F.struct(F.when(ok, label).alias("annex"), F.when(ok, F.split_part(c, F.lit("/"), F.lit(2))).alias("entry"))


def id_list(c: Column, sep: str = r"\|") -> Column:
    """Numbers of a delimited id list; what isn't one is left out."""
    return F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: x.rlike(r"^\d+$"))


def minify_markup(c: Column) -> Column:
    """Markup without declarations, comments and class attributes, white space collapsed."""
    for pattern, to in ((r"<\?[^>]*\?>", ""), (r"(?s)<!--.*?-->", ""), (r"""\s(class|id)=("[^"]*"|'[^']*')""", ""), (r"[ \t\r\n]+", " "), (r"> <", "><")):
        c = F.regexp_replace(c, pattern, to)
    return F.trim(c)


def safe_file_name(c: Column) -> Column:
    return F.translate(c, "/:?", "-- ")


def to_date_dmy(c: Column) -> Column:
    return F.try_to_date(F.nullif(F.trim(c), F.lit("")), "dd/MM/yyyy")


def chunk_key(c: Column, n: int = 2) -> Column:
    """First letters in lower case, what is no letter or digit as '_'."""
    return F.rpad(F.regexp_replace(F.lower(F.substring(c, 1, n)), "[^a-z0-9]", "_"), n, "_")


def apply_rules(value: Column, rules: Sequence[tuple[str, str, str | None]], scope: Column | None = None) -> tuple[Column, Column]:
    """(corrected, log): rules (from, to, scope value) one after the other, each on what the ones before made."""
    log = F.array().cast("array<string>")
    for old, new, within in rules:
        hit = value == old
        if within is not None and scope is not None:
            hit &= scope == within
        hit = F.coalesce(hit, F.lit(False))
        log = F.when(hit, F.array_append(log, F.lit(f"{old}->{new}"))).otherwise(log)
        value = F.when(hit, F.lit(new)).otherwise(value)
    return value, F.array_join(log, "; ")


def map_tokens(words: Column, vocabulary: dict[str, str]) -> Column:
    """Values of the tokens that a vocabulary has, in order and once each."""
    m = F.create_map(*[F.lit(x) for kv in vocabulary.items() for x in kv])
    return F.array_distinct(F.array_compact(F.transform(words, lambda x: m[x])))


def is_systematic(name: Column, most: int = 48) -> Column:
    """Whether a compound name is one of nomenclature: locants, brackets, stereo marks, or too long."""
    patterns = (r"\d,\d", r"[\[\]]", r"\([RSEZ\d,]+\)-", r"\d-[a-z]")
    return reduce(lambda a, b: a | b, (name.rlike(p) for p in patterns)) | (F.length(name) > most)


def preferred_names(pool: Column, scientific: Column, most: int) -> Column:
    """Names of a pool without case-insensitive repeats and without the scientific name and its genus."""
    genus = F.lower(F.substring_index(scientific, " ", 1))
    good = F.filter(pool, lambda x: x.isNotNull() & (F.lower(x) != F.lower(scientific)) & ~F.startswith(F.lower(x), genus))
    low = F.transform(good, F.lower)
    return F.slice(F.filter(good, lambda x, i: F.array_position(low, F.lower(x)) == i + 1), 1, most)


def display_names(names: Column, most: int, other_than: Column | None = None, fallback: bool = False) -> Column:
    """Up to `most` names of a language for a compound: no long ones, none that is the systematic name, systematic ones only as a fallback."""
    fits = F.filter(names, lambda x: (F.length(x) <= 40) & (F.lower(x) != F.coalesce(F.lower(other_than), F.lit("")) if other_than is not None else F.lit(True)))
    plain = F.filter(fits, lambda x: ~is_systematic(x))
    return F.slice(F.when((F.size(plain) > 0) | F.lit(not fallback), plain).otherwise(fits), 1, most)
