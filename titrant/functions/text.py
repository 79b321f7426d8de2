"""Names, identifiers and other short strings, as columns over built-in functions.

White space and word boundaries are Unicode's (``(?U)``) unless ``ascii_only`` is asked for, which SQL engines share.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .first_match import blank_to_null

CAS_STRICT, CAS_LOOSE = r"\A\d{1,7}-\d{2}-\d\z", r"\A\d+(?:-\d+){1,2}\z"
NO_KEY = "N/A"
# Cells that a table reader takes as missing.
MISSING_CELLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def strip(c: Column, ascii_only: bool = False) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$" if ascii_only else r"(?U)^\s+|\s+$", "")


def squeeze(c: Column, ascii_only: bool = False) -> Column:
    """Runs of white space become one blank."""
    return F.regexp_replace(c, r"\s+" if ascii_only else r"(?U)\s+", " ")


def is_cas(c: Column, loose: bool = False) -> Column:
    return F.coalesce(c.rlike(CAS_LOOSE if loose else CAS_STRICT), F.lit(False))


def lookup_key(cas: Column, strict_keys: bool = False) -> Column:
    """The key of look-ups by registry number. Records without one share the row ``N/A``, unless ``strict_keys``."""
    return blank_to_null(cas) if strict_keys else F.coalesce(blank_to_null(cas), F.lit(NO_KEY))


def csv_cell(c: Column) -> Column:
    """A cell as an all-text reader gives it: missing ones are empty."""
    return F.when(c.isNull() | c.isin(*MISSING_CELLS), F.lit("")).otherwise(c)


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin("true", "1", "yes"), F.lit(False))


def normalize_name(c: Column, ascii_only: bool = False) -> Column:
    """Lower case, single blanks, without one parenthesis of 1 to 30 characters at the end."""
    flat = squeeze(strip(F.lower(c), ascii_only), ascii_only)
    return strip(F.regexp_replace(flat, r"\s*\([^)]{1,30}\)\s*$", ""), ascii_only)


def normalize_identifier(c: Column) -> Column:
    return squeeze(strip(F.upper(c)))


def normalize_source(c: Column) -> Column:
    return squeeze(strip(F.lower(c)))


def match_form(c: Column, ascii_only: bool = False) -> Column:
    """For finding words of a heading: no colon at the end, punctuation and conjunctions as blanks."""
    bare = strip(F.regexp_replace(strip(F.lower(c), ascii_only), r":+$", ""), ascii_only)
    spaced = F.regexp_replace(F.regexp_replace(bare, r"[,/&\-]+", " "), r"\s+(and|or)\s+", " ")
    return strip(squeeze(spaced, ascii_only), ascii_only)


def slugify(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def clean_catalog(c: Column) -> Column:
    """A catalogue number without ``Cat#`` or ``#`` before it."""
    return strip(F.regexp_replace(strip(F.regexp_replace(strip(c), r"(?i)^cat\s*#\s*", "")), r"^#\s*", ""))


def title_case(c: Column) -> Column:
    """Every run of letters begins with a capital."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))), "")


# Words that a protein's name is searched without, and Greek letters.
GREEK = ("αΑβΒγΓδΔεΕκΚλΛμΜωΩ", "AABBGGDDEEKKLLMMWW")
_DROPPED = (
    r"(?iU)\b(?:recombinant|human|murine|mouse|rat|bovine|porcine|rabbit|goat|sheep|zebrafish|drosophila|xenopus|yeast|bacterial|e\.?\s*coli|his-?tagged?|his\d*|gst-?fusion|gst|flag-?tagged?|active|carrier-?free|lyophilized?|biotinylated?|"
    r"ultrapure|certified|dialyzed?|heat-?inactivated?|charcoal-?stripped?|ultra-?low|low-?endotoxin|cell-?culture-?grade|(?:r&d\s*systems?|peprotech|gibco|thermo|sigma|neb|abcam|cst|invitrogen|millipore|calbiochem|tocris|stemcell)\s*|cat#?|≥\d+%)\b"
)


def clean_protein_name(c: Column) -> Column:
    return strip(squeeze(F.regexp_replace(F.translate(c, *GREEK), _DROPPED, " ")))


def protein_queries(name: Column) -> Column:
    """Search terms in the order in which to try them: an array of ``label, query``."""
    clean = clean_protein_name(name)
    gene = F.regexp_replace(F.upper(clean), r"\s+", "")
    bare = F.regexp_replace(gene, "-", "")
    human, any_one = " AND reviewed:true AND organism_id:9606", " AND reviewed:true"
    words = F.split(clean, " ")
    row = lambda label, *parts: F.struct(F.lit(label).alias("label"), F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]).alias("query"))
    short = F.array_compact(F.array(
        row("gene_human", "gene:", gene, human), row("name_exact", 'protein_name:"', clean, '"' + human), row("gene_any", "gene:", gene, any_one),
        F.when((bare != gene) & (F.length(bare) <= 10), row("gene_nohyphen", "gene:", bare, human)),
    ))
    long = F.array_compact(F.array(row("name_exact", 'protein_name:"', clean, '"' + any_one), F.when(F.size(words) >= 3, row("name_partial", 'protein_name:"', F.array_join(F.slice(words, 1, 3), " "), '"' + any_one))))
    return F.when(F.length(gene).between(2, 12), short).otherwise(long)


def long_tokens(c: Column) -> Column:
    """Letter and digit runs of four characters or more."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) >= 4)


def names_roughly_match(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(long_tokens(a), long_tokens(b)), F.lit(False))


def year_of(date: Column) -> Column:
    return F.substring(date, 1, 4)


def vendor_label(brand: Column, number: Column) -> Column:
    return F.trim(F.concat_ws(" ", brand, number))


def warning_list(*warnings: Column) -> Column:
    return F.concat_ws(";", *warnings)


def source_ref(template: str, *parts: Column) -> Column:
    """``uniprot:%s``, ``section_%s:'%s'`` and the like."""
    return F.format_string(template, *parts)
