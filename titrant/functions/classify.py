"""Ordered classifications: table categories, header roles, reagent classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .first_match import all_of, any_of, contains_any, first_match
from .text import match_form, strip

# Categories in order, each with sets of words that together name it.
CATEGORIES = (
    ("Recombinant DNA", (("recombinant dna",), ("plasmid",), ("expression vector",))),
    ("Experimental Models: Cell Lines", (("cell line",), ("experimental model", "cell"))),
    ("Experimental Models: Organisms/Strains", (("mouse strain",), ("mouse line",), ("zebrafish",), ("drosophila",), ("c elegans",), ("experimental model", "organism"), ("organism",))),
    ("Bacterial and Virus Strains", (("bacterial", "strain"), ("virus", "strain"), ("viral", "strain"), ("bacteria",))),
    ("Antibodies", (("antibod",),)),
    ("Critical Commercial Assays", (("critical", "assay"), ("commercial", "assay"), ("commercial kit",))),
    ("Deposited Data", (("deposited", "data"), ("public data",), ("data deposited",))),
    ("Oligonucleotides", (("oligonucleotide",), ("oligo",), ("primer",), ("sgrna",), ("sirna",), ("shrna",))),
    ("Software and Algorithms", (("software",), ("algorithm",))),
    ("Biological Samples", (("biological", "sample"), ("biospecimen",), ("clinical sample",), ("patient sample",))),
    ("Chemicals, Peptides, and Recombinant Proteins", (("chemical",), ("peptide",), ("recombinant", "protein"), ("recombinant peptide",))),
    ("Other", (("other",),)),
)
FILLERS = ("—", "–", "-", ".", "...", "…", "n/a", "na", "none", "not applicable", "*")
# Header roles in order, each with the words that name it.
HEADER_ROLES = (
    ("category", ("category", "resource type")),
    ("reagent", ("reagent", "resource")),
    ("source", ("source",)),
    ("identifier", ("identifier", "rrid", "cat#", "catalog")),
    ("additional", ("additional", "note", "comment")),
)
HEADER_ECHOES = ("reagent or resource", "reagent", "resource", "reagent/resource", "reagent or resources")


def canonical_category(c: Column, ascii_only: bool = False) -> Column:
    named = lambda form: first_match([(any_of([all_of([form.contains(a) for a in anchors]) for anchors in sets]), name) for name, sets in CATEGORIES])
    # bound to a variable, so that it is made once and not for every word
    return F.get(F.transform(F.array(match_form(c, ascii_only)), named), F.lit(0))


def is_filler(cell: Column, first: Column) -> Column:
    bare = strip(cell)
    return (bare == "") | F.lower(bare).isin(*FILLERS) | (bare == first)


def heading_category(cells: Column) -> Column:
    """The category that a row names if all its other cells are empty, fillers or the same; else null."""
    first = strip(F.get(cells, F.lit(0)))
    rest = F.slice(cells, F.lit(2), F.greatest(F.size(cells), F.lit(1)))
    return F.when((first != "") & F.forall(rest, lambda c: is_filler(c, first)), canonical_category(first))


def header_role(c: Column) -> Column:
    form = F.lower(strip(c))
    return first_match([(contains_any(form, words), role) for role, words in HEADER_ROLES])


# Words and patterns of the reagent classes.
_KIT = (
    "master mix", "mastermix", "assembly master", "quickextract", "trizol", "tri reagent", "qiazol", "transfection reagent", "transfection mix", "gateway cloning", "topo cloning", "cell dissociation buffer", "mounting medium", "mounting media", "prolong",
    "vectashield", "slowfade", "fluoromount",
)
_NOT_SERUM = ("medium", "media", "replacement", "supplement")
_NOT_ANTI = ("antimycin", "antibiotic", "antimycotic", "antifade", "antioxidant", "antigen")
_ANTIBODY = ("monoclonal ab", "polyclonal ab", "isotype control", "secondary ab", "primary ab")
_FACTOR = (
    "il-", "interleukin", "tnf-", "tumor necrosis factor", "ifn-", "interferon-", "growth factor", "cytokine", "chemokine", "pdgf", "vegf", "egf", "fgf-", "tgf-b", "tgf-a", "ngf", "bdnf", "gdnf", "nt-3", "nt-4", "cntf", "g-csf", "m-csf", "gm-csf",
    "thrombopoietin", "erythropoietin", "scf", "stem cell factor", "bmp-", " bmp ", "wnt-", "sonic hedgehog", " shh", "r-spondin", "rspo", "noggin", "dkk-", "activin-", "follistatin", "oncostatin", "leukemia inhibitory factor", " lif", "cxcl", " ccl2",
    " ccl5", "insulin-like growth factor", " igf-",
)
_MEDIA = (
    "dmem", "rpmi", "neurobasal", "opti-mem", "optimem", "iscove", "leibovitz", "dulbecco", "roswell park", "minimum essential medium", "eagle medium", "penicillin-streptomycin", "pen/strep", "pen strep", "b-27", "b27 supplement", "n2 supplement",
    "n-2 supplement", "insulin-transferrin-selenium", " its ", "its+", "glutamax", "knockout serum replacement", "knockout sr", "middlebrook", "gentamicin", "hygromycin", "zeocin", "blasticidin", "normocin", "fungizone", "amphotericin",
)
_KIT_PATTERNS = (
    r"\b(nuclease|rnase|dnase)-free\s+water\b", r"\b(reaction\s+buffer|ligation\s+buffer|buffer\s+only)\b", r"\b(protein\s+gels?|polyacrylamide\s+gel|bis-tris)\b",
    r"\b(sensor\s+chip|chromatography\s+column|sephadex|superdex|superose|sepharose\s+cl)\b", r"\b(assay\s+reagent|assay\s+substrate|dab\s+substrate|hrp\s+substrate|peroxidase\s+substrate|lysis\s+reagent|electroporation\s+enhancer)\b",
)
_ENZYME = (
    "dnase", "rnase", "collagenase", "dispase", "liberase", "trypsin", "elastase", "papain", "hyaluronidase", "chitinase", "lysozyme", "proteinase k", "benzonase", "nuclease", "protease", "cre recombinase", "flp recombinase", "cas9", "cpf1", "cas12", "crispr",
    "luciferase", "galactosidase", "glucuronidase", "alkaline phosphatase", "horseradish peroxidase", "fibronectin", "laminin", "vitronectin", "entactin", "matrigel", "geltrex", "basement membrane", "streptavidin", "neutravidin", "avidin", "protein a",
    "protein g", "protein l", "albumin", "coenzyme a", "coenzyme ", "cytochalasin", "jasplakinolide", "phalloidin",
)
_ENZYME_PATTERNS = (r"\b\w{3,}ase\b", r"\b(polymerase|ligase|kinase|phosphatase|synthase|reductase|oxidase|transferase|isomerase|transposase|integrase|helicase)\b")


def reagent_class(c: Column, ascii_only: bool = False) -> Column:
    """serum, enzyme, antibody, growth_factor, media, kit or other: the first whose signs the name has."""
    n = strip(F.lower(c), ascii_only)
    has = lambda pattern: n.rlike(pattern if ascii_only else "(?U)" + pattern)
    return first_match(
        [
            (has(r"\bkit\b") | contains_any(n, _KIT), "kit"),
            (n.contains("serum") & ~contains_any(n, _NOT_SERUM), "serum"),
            (has(r"\bplasma\b") & ~contains_any(n, ("plasmid", "medium")), "serum"),
            (contains_any(n, ("antibody", "antibodies")), "antibody"),
            (has(r"\banti[-\s]\w") & ~contains_any(n, _NOT_ANTI), "antibody"),
            (has(r"\b(igg|igm|iga|igy)\b") | contains_any(n, _ANTIBODY), "antibody"),
            (contains_any(n, _FACTOR), "growth_factor"),
            (has(r"\brecombinant\b") & ~has(r"\b(trypsin|dnase|rnase|cas9)\b"), "growth_factor"),
            (contains_any(n, _MEDIA), "media"),
            (has(r"\bmedium\b") & ~contains_any(n, ("chain", "pore")), "media"),
            (any_of([has(p) for p in _KIT_PATTERNS]) | n.contains("assay dye"), "kit"),
            (contains_any(n, _ENZYME) | any_of([has(p) for p in _ENZYME_PATTERNS]), "enzyme"),
        ],
        "other",
    )
