"""Reference tables as plain data: label map, Gram classes, drug panels, exclusions and evidence rules.

Every table can be replaced by a caller's own DataFrame or CSV (`cohortgram.sources.seeds`).
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------------------------------
# Vocabulary of the source and of the reports.
# --------------------------------------------------------------------------------------------------
COHORT_OF_DESCRIPTION = {"BLOOD": "blood", "URINE": "urine", "RESPIRATORY": "respiratory"}
COHORTS = ("blood", "respiratory", "urine")

SUSCEPTIBLE, INTERMEDIATE, RESISTANT = "Susceptible", "Intermediate", "Resistant"
INCONCLUSIVE, SYNERGISM = "Inconclusive", "Synergism"
CATEGORISED = (SUSCEPTIBLE, INTERMEDIATE, RESISTANT)

WILDCARD = "*"
PHENOTYPES = (
    "base",
    "esce_r",
    "overall",
    "oxacillin_resistant",
    "oxacillin_susceptible",
    "vancomycin_resistant",
)
INTERNAL_PHENOTYPES = ("cre", "mdr_p_aeruginosa")
EXCLUSION_REASONS = (
    "expected_resistant",
    "ampc_reporting_suppression",
    "inappropriate_surrogate",
    "no_current_breakpoint",
    "phenotype_reporting_suppression",
    "source_category_limitation",
    "project_panel_exclusion",
)

E_COLI = "Escherichia coli"
S_AUREUS = "Staphylococcus aureus"
E_FAECALIS, E_FAECIUM = "Enterococcus faecalis", "Enterococcus faecium"
P_AERUGINOSA = "Pseudomonas aeruginosa"
K_PNEUMONIAE, K_OXYTOCA, K_AEROGENES = "Klebsiella pneumoniae", "Klebsiella oxytoca", "Klebsiella aerogenes"
E_CLOACAE = "Enterobacter cloacae complex"
C_FREUNDII, C_KOSERI, C_FARMERI = "Citrobacter freundii complex", "Citrobacter koseri", "Citrobacter farmeri"
P_MIRABILIS, M_MORGANII = "Proteus mirabilis", "Morganella morganii"
S_MARCESCENS, S_MALTOPHILIA = "Serratia marcescens", "Stenotrophomonas maltophilia"
S_AGALACTIAE, S_PNEUMONIAE = "Streptococcus agalactiae", "Streptococcus pneumoniae"
CONS = "Coagulase-negative staphylococci (unspeciated)"
ENTEROCOCCUS_SPP = "Enterococcus species (unspeciated)"

# --------------------------------------------------------------------------------------------------
# Reviewed source labels, as (label, standard name, reporting group, qualifier, notes).
# --------------------------------------------------------------------------------------------------
PHENOTYPE_KEPT, MORPHOTYPE_KEPT = "Resistance phenotype retained separately", "Morphotype retained separately"
INTO_CLOACAE = "Grouped to reviewed Enterobacter cloacae complex reporting category"
INTO_FREUNDII = "Grouped to reviewed Citrobacter freundii complex reporting category"
REVIEWED_LABELS = (
    ("ESCHERICHIA COLI", E_COLI, E_COLI, None, None),
    ("ESCHERICHIA COLI (CARBAPENEM RESISTANT)", E_COLI, E_COLI, "carbapenem_resistant", PHENOTYPE_KEPT),
    ("STAPHYLOCOCCUS AUREUS", S_AUREUS, S_AUREUS, None, None),
    ("STAPH AUREUS {MRSA}", S_AUREUS, S_AUREUS, "MRSA", PHENOTYPE_KEPT),
    (
        "STAPH AUREUS(COLONY VARIANT - SMALL COLONY OR OTHER MORPHOTYPE)",
        S_AUREUS,
        S_AUREUS,
        "small_colony_or_other_morphotype",
        MORPHOTYPE_KEPT,
    ),
    ("KLEBSIELLA PNEUMONIAE", K_PNEUMONIAE, K_PNEUMONIAE, None, None),
    (
        "KLEBSIELLA PNEUMONIAE (CARBAPENEM RESISTANT)",
        K_PNEUMONIAE,
        K_PNEUMONIAE,
        "carbapenem_resistant",
        PHENOTYPE_KEPT,
    ),
    ("ENTEROCOCCUS FAECALIS", E_FAECALIS, E_FAECALIS, None, None),
    ("ENTEROCOCCUS FAECALIS - VANCO RESISTANT", E_FAECALIS, E_FAECALIS, "vancomycin_resistant", PHENOTYPE_KEPT),
    ("PSEUDOMONAS AERUGINOSA", P_AERUGINOSA, P_AERUGINOSA, None, None),
    ("MUCOID PSEUDOMONAS AERUGINOSA", P_AERUGINOSA, P_AERUGINOSA, "mucoid", MORPHOTYPE_KEPT),
    ("PSEUDOMONAS AERUGINOSA (NON-MUCOID CF)", P_AERUGINOSA, P_AERUGINOSA, "non_mucoid_cf", MORPHOTYPE_KEPT),
    ("ENTEROBACTER CLOACAE COMPLEX", E_CLOACAE, E_CLOACAE, None, None),
    (
        "ENTEROBACTER CLOACAE COMPLEX (CARBAPENEM RESISTANT)",
        E_CLOACAE,
        E_CLOACAE,
        "carbapenem_resistant",
        PHENOTYPE_KEPT,
    ),
    ("KLEBSIELLA OXYTOCA", K_OXYTOCA, K_OXYTOCA, None, None),
    ("PROTEUS MIRABILIS", P_MIRABILIS, P_MIRABILIS, None, None),
    ("ENTEROCOCCUS FAECIUM", E_FAECIUM, E_FAECIUM, None, None),
    ("ENTEROCOCCUS FAECIUM -  VANCO RESISTANT", E_FAECIUM, E_FAECIUM, "vancomycin_resistant", PHENOTYPE_KEPT),
    ("STREPTOCOCCUS PNEUMONIAE", S_PNEUMONIAE, S_PNEUMONIAE, None, None),
    ("STREPTOCOCCUS AGALACTIAE (GROUP B)", S_AGALACTIAE, S_AGALACTIAE, "group_b", None),
    ("STREPTOCOCCUS AGALACTIAE {GROUP B}", S_AGALACTIAE, S_AGALACTIAE, "group_b", "Formatting variant"),
    ("SERRATIA MARCESCENS", S_MARCESCENS, S_MARCESCENS, None, None),
    (
        "SERRATIA MARCESCENS (CARBAPENEM RESISTANT)",
        S_MARCESCENS,
        S_MARCESCENS,
        "carbapenem_resistant",
        PHENOTYPE_KEPT,
    ),
    ("ENTEROBACTER ASBURIAE", "Enterobacter asburiae", E_CLOACAE, None, INTO_CLOACAE),
    ("ENTEROBACTER CLOACAE", "Enterobacter cloacae", E_CLOACAE, None, INTO_CLOACAE),
    ("KLEBSIELLA AEROGENES", K_AEROGENES, K_AEROGENES, None, None),
    ("KLEBSIELLA AEROGENES (CARBAPENEM RESISTANT)", K_AEROGENES, K_AEROGENES, "carbapenem_resistant", PHENOTYPE_KEPT),
    ("ZZZENTEROBACTER AEROGENES", K_AEROGENES, K_AEROGENES, None, "Historical Enterobacter aerogenes terminology"),
    ("CITROBACTER BRAAKII", "Citrobacter braakii", C_FREUNDII, None, INTO_FREUNDII),
    ("ZZZCITROBACTER FARMERI", C_FARMERI, C_FARMERI, None, "Historical source label"),
    ("CITROBACTER FREUNDII", "Citrobacter freundii", C_FREUNDII, None, INTO_FREUNDII),
    ("CITROBACTER FREUNDII COMPLEX", C_FREUNDII, C_FREUNDII, None, None),
    (
        "CITROBACTER FREUNDII COMPLEX (CARBAPENEM RESISTANT)",
        C_FREUNDII,
        C_FREUNDII,
        "carbapenem_resistant",
        PHENOTYPE_KEPT,
    ),
    ("CITROBACTER KOSERI", C_KOSERI, C_KOSERI, None, None),
    ("CITROBACTER KOSERI (CARBAPENEM RESISTANT)", C_KOSERI, C_KOSERI, "carbapenem_resistant", PHENOTYPE_KEPT),
    ("CITROBACTER YOUNGAE", "Citrobacter youngae", C_FREUNDII, None, INTO_FREUNDII),
    (
        "COAG NEGATIVE STAPHYLOCOCCUS",
        CONS,
        CONS,
        None,
        "Unspeciated CoNS source label; pooled reporting group; exclude separately identified species",
    ),
    (
        "STAPHYLOCOCCUS SPECIES - COAG NEGATIVE, NOT STAPH SAPROPHYTICUS",
        CONS,
        CONS,
        "excludes_saprophyticus",
        "Nonspeciated CoNS, excluding S. saprophyticus per source label; do not add species-specific isolates to pool",
    ),
    (
        "ENTEROCOCCUS SPECIES",
        ENTEROCOCCUS_SPP,
        ENTEROCOCCUS_SPP,
        None,
        "Unspeciated source identification; keep separate from identified E. faecalis and E. faecium",
    ),
    (
        "MORGANELLA MORGANII",
        M_MORGANII,
        M_MORGANII,
        None,
        "Species-level identity; source categorical AST retained unchanged",
    ),
    (
        "STENOTROPHOMONAS MALTOPHILIA",
        S_MALTOPHILIA,
        S_MALTOPHILIA,
        None,
        "Species-level identity; special AST interpretation considerations documented separately",
    ),
)

# Reporting groups that are Gram positive; every other reporting group is Gram negative.
GRAM_POSITIVE_GROUPS = (CONS, E_FAECALIS, E_FAECIUM, ENTEROCOCCUS_SPP, S_AUREUS, S_AGALACTIAE, S_PNEUMONIAE)

# --------------------------------------------------------------------------------------------------
# Drug panels in report order. A panel holds for every cohort unless CONTEXT_PANELS names
# the group and cohort; PROPOSED names panel entries that are listed but not reviewed yet.
# --------------------------------------------------------------------------------------------------
SXT, TZP = "Trimethoprim/Sulfamethoxazole", "Piperacillin/Tazobactam"
CIP, GEN, MEM, ETP, LVX = "Ciprofloxacin", "Gentamicin", "Meropenem", "Ertapenem", "Levofloxacin"
CRO, CAZ, FEP, AMP, PEN = "Ceftriaxone", "Ceftazidime", "Cefepime", "Ampicillin", "Penicillin"
VAN, LZD, DAP, OXA, CLI, ERY = "Vancomycin", "Linezolid", "Daptomycin", "Oxacillin", "Clindamycin", "Erythromycin"
NIT, FOX, CTX, CFZ = "Nitrofurantoin", "Cefoxitin", "Cefotaxime", "Cefazolin"
AMC, SAM, CXM = "Amoxicillin/Clavulanic Acid", "Ampicillin/Sulbactam", "Cefuroxime"

PANELS = {
    C_FREUNDII: (CIP, GEN, SXT, FEP, MEM, ETP, LVX),
    C_KOSERI: (CRO, CIP, GEN, SXT, MEM, ETP, LVX, TZP),
    E_CLOACAE: (GEN, MEM, SXT, CIP, CRO, TZP),
    E_FAECALIS: (AMP, VAN, PEN, LZD, DAP),
    E_FAECIUM: (AMP, VAN, PEN, LZD, DAP),
    E_COLI: (CRO, CIP, SXT, GEN, TZP, MEM, AMP),
    K_AEROGENES: (GEN, CIP, SXT, FEP, MEM, ETP, LVX),
    K_OXYTOCA: (CRO, CIP, GEN, MEM, SXT, TZP),
    K_PNEUMONIAE: (CRO, CIP, GEN, MEM, SXT, TZP),
    M_MORGANII: (CIP, GEN, SXT, TZP, CRO, MEM, ETP, LVX),
    P_MIRABILIS: (AMP, CRO, CIP, SXT, GEN, TZP, MEM),
    P_AERUGINOSA: (FEP, TZP, MEM, CIP, "Tobramycin", "Amikacin", GEN, CAZ),
    S_MARCESCENS: (CRO, CIP, SXT, GEN, MEM, CAZ),
    S_AUREUS: (OXA, VAN, CLI, ERY, SXT, LZD),
    S_MALTOPHILIA: (SXT, LVX),
    S_AGALACTIAE: (PEN, CLI, ERY, VAN),
    S_PNEUMONIAE: (PEN, CRO, ERY, SXT, LVX, "Moxifloxacin", VAN),
}
CONTEXT_PANELS = {
    (C_FREUNDII, "respiratory"): (CIP, GEN, SXT, FEP, LVX),
    (C_KOSERI, "urine"): (CRO, CIP, GEN, SXT, MEM, ETP, LVX, TZP, NIT),
    (M_MORGANII, "respiratory"): (CIP, GEN, SXT, TZP, LVX),
    (CONS, "blood"): (OXA, VAN, SXT, CLI, ERY, LZD),
    (ENTEROCOCCUS_SPP, "urine"): (AMP, PEN, VAN, LZD, NIT),
}
PROPOSED = {
    (C_FREUNDII, "urine"): (FEP,),
    (C_KOSERI, "respiratory"): (MEM, ETP),
    (CONS, "blood"): (OXA, CLI, LZD),
    (ENTEROCOCCUS_SPP, "urine"): (PEN, VAN, LZD),
    (K_AEROGENES, "urine"): (FEP,),
    (M_MORGANII, "respiratory"): (LVX,),
}

# --------------------------------------------------------------------------------------------------
# Exclusions, as (group, cohort, phenotype, drug, reason, review basis, notes). A cohort or
# phenotype of "*" holds for all of them.
# --------------------------------------------------------------------------------------------------
OWNER_REVIEW, EUCAST = "Project owner review 2026-10-13", "EUCAST expected resistant phenotype"
MORGANII_REVIEW = "M. morganii expected phenotype / literature review"
BASAL_AMPC = "Basal AmpC intrinsic resistance; source categorical AST is retained upstream"
FREUNDII_RULE = "Project applies C. freundii AmpC reporting rule at reviewed reporting-group level"
MODERATE_RISK = "Moderate-risk inducible AmpC organism; suppress from summary antibiogram"
NOT_PREFERRED = "Not preferred for invasive infection with moderate-risk inducible AmpC organisms"
NOT_IN_SUMMARY = "Do not include in susceptibility summary"
SUPPRESS_DRUG = (
    "Suppress the reviewed drug within this resistance-defined reporting population; "
    "preserve AST used to establish phenotype eligibility."
)
NOT_ROUTINE = (
    "Project owner excludes this combination from the routine antibiogram panel in this cohort and phenotype; "
    "preserve upstream AST and phenotype evidence."
)
DAPTOMYCIN_CATEGORY = (
    "Suppress conventional percent-susceptible display for the reviewed E. faecium daptomycin category; "
    "retain source S/I/R without inferring SDD."
)
EXCLUSIONS = (
    (C_FREUNDII, "*", "*", AMC, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (C_FREUNDII, "*", "*", AMP, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (C_FREUNDII, "*", "*", SAM, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (C_FREUNDII, "*", "*", CFZ, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (C_FREUNDII, "*", "*", CTX, "ampc_reporting_suppression", "IDSA 2026", FREUNDII_RULE),
    (C_FREUNDII, "*", "*", FOX, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (C_FREUNDII, "*", "*", CAZ, "ampc_reporting_suppression", "IDSA 2026", FREUNDII_RULE),
    (C_FREUNDII, "*", "*", CRO, "ampc_reporting_suppression", "IDSA 2026", FREUNDII_RULE),
    (C_FREUNDII, "*", "*", TZP, "ampc_reporting_suppression", "IDSA 2026", FREUNDII_RULE),
    (
        C_KOSERI,
        "*",
        "*",
        CFZ,
        "inappropriate_surrogate",
        "CLSI AST Case Study (2019)",
        "Cefazolin is not validated as an oral-cephalosporin surrogate for C. koseri",
    ),
    (E_CLOACAE, "*", "*", CTX, "ampc_reporting_suppression", "IDSA 2026", MODERATE_RISK),
    (
        E_CLOACAE,
        "*",
        "*",
        FOX,
        "expected_resistant",
        "expected phenotype",
        "Chromosomal AmpC-associated expected resistance",
    ),
    (E_CLOACAE, "*", "*", CAZ, "ampc_reporting_suppression", "IDSA 2026", MODERATE_RISK),
    (E_CLOACAE, "*", "*", CRO, "ampc_reporting_suppression", "IDSA 2026", MODERATE_RISK),
    (E_CLOACAE, "*", "*", TZP, "ampc_reporting_suppression", "IDSA 2026", NOT_PREFERRED),
    (
        E_FAECALIS,
        "blood",
        "vancomycin_resistant",
        VAN,
        "phenotype_reporting_suppression",
        OWNER_REVIEW,
        SUPPRESS_DRUG,
    ),
    (E_FAECIUM, "blood", "base", DAP, "source_category_limitation", OWNER_REVIEW, DAPTOMYCIN_CATEGORY),
    (E_FAECIUM, "blood", "vancomycin_resistant", AMP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (
        E_FAECIUM,
        "blood",
        "vancomycin_resistant",
        DAP,
        "source_category_limitation",
        OWNER_REVIEW,
        DAPTOMYCIN_CATEGORY,
    ),
    (E_FAECIUM, "blood", "vancomycin_resistant", PEN, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (E_FAECIUM, "blood", "vancomycin_resistant", VAN, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (E_FAECIUM, "urine", "vancomycin_resistant", AMP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (E_FAECIUM, "urine", "vancomycin_resistant", PEN, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (E_FAECIUM, "urine", "vancomycin_resistant", VAN, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (E_COLI, "blood", "esce_r", AMP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (E_COLI, "blood", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (E_COLI, "respiratory", "esce_r", AMP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (E_COLI, "respiratory", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (E_COLI, "urine", "esce_r", AMP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (E_COLI, "urine", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (K_AEROGENES, "*", "*", AMC, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (K_AEROGENES, "*", "*", AMP, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (K_AEROGENES, "*", "*", SAM, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (K_AEROGENES, "*", "*", CFZ, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (K_AEROGENES, "*", "*", CTX, "ampc_reporting_suppression", "IDSA 2026", MODERATE_RISK),
    (K_AEROGENES, "*", "*", FOX, "expected_resistant", "IDSA AMR Guidance 2026", BASAL_AMPC),
    (K_AEROGENES, "*", "*", CAZ, "ampc_reporting_suppression", "IDSA 2026", MODERATE_RISK),
    (K_AEROGENES, "*", "*", CRO, "ampc_reporting_suppression", "IDSA 2026", MODERATE_RISK),
    (K_AEROGENES, "*", "*", TZP, "ampc_reporting_suppression", "IDSA 2026", NOT_PREFERRED),
    (K_OXYTOCA, "*", "*", AMP, "expected_resistant", EUCAST, NOT_IN_SUMMARY),
    (K_OXYTOCA, "blood", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (K_OXYTOCA, "respiratory", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (K_OXYTOCA, "respiratory", "esce_r", CIP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (K_OXYTOCA, "respiratory", "esce_r", GEN, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (K_OXYTOCA, "respiratory", "esce_r", SXT, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (K_OXYTOCA, "urine", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (K_PNEUMONIAE, "*", "*", AMP, "expected_resistant", EUCAST, NOT_IN_SUMMARY),
    (K_PNEUMONIAE, "blood", "esce_r", TZP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (K_PNEUMONIAE, "respiratory", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (K_PNEUMONIAE, "respiratory", "esce_r", TZP, "project_panel_exclusion", OWNER_REVIEW, NOT_ROUTINE),
    (K_PNEUMONIAE, "urine", "esce_r", CRO, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (
        M_MORGANII,
        "*",
        "*",
        AMC,
        "expected_resistant",
        MORGANII_REVIEW,
        "Not appropriate for routine M. morganii susceptibility display",
    ),
    (
        M_MORGANII,
        "*",
        "*",
        AMP,
        "expected_resistant",
        MORGANII_REVIEW,
        "Not appropriate for routine M. morganii susceptibility display",
    ),
    (
        M_MORGANII,
        "*",
        "*",
        CFZ,
        "expected_resistant",
        MORGANII_REVIEW,
        "Not appropriate for routine M. morganii susceptibility display",
    ),
    (
        M_MORGANII,
        "*",
        "*",
        CXM,
        "expected_resistant",
        MORGANII_REVIEW,
        "Not appropriate for routine M. morganii susceptibility display",
    ),
    (
        M_MORGANII,
        "*",
        "*",
        NIT,
        "expected_resistant",
        MORGANII_REVIEW,
        "Not appropriate for routine M. morganii susceptibility display",
    ),
    (S_MARCESCENS, "*", "*", FOX, "expected_resistant", EUCAST, NOT_IN_SUMMARY),
    (S_AUREUS, "blood", "oxacillin_resistant", OXA, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (
        S_AUREUS,
        "respiratory",
        "oxacillin_resistant",
        OXA,
        "phenotype_reporting_suppression",
        OWNER_REVIEW,
        SUPPRESS_DRUG,
    ),
    (S_AUREUS, "urine", "oxacillin_resistant", OXA, "phenotype_reporting_suppression", OWNER_REVIEW, SUPPRESS_DRUG),
    (
        S_MALTOPHILIA,
        "*",
        "*",
        CAZ,
        "no_current_breakpoint",
        "CLSI AST News Update (May 2025)",
        "CLSI ceftazidime breakpoint was removed in 2024",
    ),
)


# --------------------------------------------------------------------------------------------------
# Evidence rules
# --------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Scope:
    """Organisms a rule applies to, by standard name, standard-name prefix or source-label prefix."""

    name: str
    standard_names: tuple[str, ...] = ()
    standard_prefixes: tuple[str, ...] = ()
    label_prefixes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Evidence:
    """The drugs that count for one scope of a rule, or for one category of a k-of-n rule."""

    name: str
    drugs: dict[str, tuple[str, ...]]
    positive: tuple[str, ...] = (RESISTANT,)
    negative: tuple[str, ...] = (SUSCEPTIBLE, INTERMEDIATE)


@dataclass(frozen=True)
class Rule:
    """One phenotype rule.

    Scopes are tried in order; ``needed`` is k of a k-of-n rule. ``suffix`` goes on the display name of a
    positive record, unless the status column ``plain_if_positive`` is positive as well.
    """

    name: str
    status: str
    flag: str
    phenotype: str
    scopes: tuple[Scope, ...]
    evidence: tuple[Evidence, ...]
    needed: int | None = None
    suffix: str | None = None
    plain_if_positive: str | None = None


# Scope and drugs of each rule.
CEPHALOSPORINS = (FEP, CAZ, "Ceftazidime/Avibactam", "Ceftolozane/Tazobactam")
CRE = Rule(
    name="cre",
    status="ast_cre_status",
    flag="is_cre",
    phenotype="cre",
    scopes=(
        Scope(
            "proteus_morganella",
            standard_names=(M_MORGANII,),
            standard_prefixes=("Proteus ",),
            label_prefixes=("MORGANELLA MORGANII", "PROTEUS "),
        ),
        Scope(
            "standard",
            standard_names=(E_COLI, S_MARCESCENS),
            standard_prefixes=("Citrobacter ", "Enterobacter ", "Klebsiella "),
            label_prefixes=(
                "CITROBACTER ",
                "ZZZCITROBACTER ",
                "ENTEROBACTER ",
                "ESCHERICHIA COLI",
                "KLEBSIELLA ",
                "SERRATIA MARCESCENS",
            ),
        ),
    ),
    evidence=(
        Evidence(
            "cre",
            {
                "standard": (ETP, "Imipenem", MEM, "Meropenem/Vaborbactam", "Imipenem/Relebactam"),
                "proteus_morganella": (ETP, MEM, "Meropenem/Vaborbactam"),
            },
        ),
    ),
)
MDR = Rule(
    name="mdr",
    status="ast_mdr_p_aeruginosa_status",
    flag="is_mdr_p_aeruginosa",
    phenotype="mdr_p_aeruginosa",
    scopes=(Scope("eligible", standard_names=(P_AERUGINOSA,)),),
    evidence=tuple(
        Evidence(f"mdr_{name}", {"eligible": drugs}, positive=(INTERMEDIATE, RESISTANT), negative=(SUSCEPTIBLE,))
        for name, drugs in (
            ("es_ceph", CEPHALOSPORINS),
            ("fq", (CIP, LVX)),
            ("aminoglycoside", ("Tobramycin",)),
            ("carbapenem", ("Imipenem", MEM, "Imipenem/Relebactam")),
            ("piptazo", (TZP,)),
            ("cefiderocol", ("Cefiderocol",)),
        )
    ),
    needed=3,
)
OXACILLIN = Rule(
    name="oxacillin",
    status="ast_oxacillin_resistance_status",
    flag="is_oxacillin_resistant",
    phenotype="oxacillin_resistant",
    scopes=(Scope("eligible", standard_names=(S_AUREUS,)),),
    evidence=(Evidence("oxacillin", {"eligible": (OXA, FOX)}),),
    suffix="oxacillin resistant",
)
VRE = Rule(
    name="vre",
    status="ast_vancomycin_resistance_status",
    flag="is_vancomycin_resistant",
    phenotype="vancomycin_resistant",
    scopes=(Scope("eligible", standard_names=(E_FAECALIS, E_FAECIUM)),),
    evidence=(Evidence("vre", {"eligible": (VAN,)}),),
    suffix="vancomycin resistant",
)
ESCE = Rule(
    name="esce",
    status="ast_esce_enterobacterales_status",
    flag="is_esce_enterobacterales",
    phenotype="esce_r",
    scopes=(
        Scope(
            "eligible",
            standard_names=(E_COLI, K_AEROGENES, K_OXYTOCA, K_PNEUMONIAE),
            standard_prefixes=("Enterobacter ",),
            label_prefixes=(
                "ESCHERICHIA COLI",
                "KLEBSIELLA AEROGENES",
                "KLEBSIELLA OXYTOCA",
                "KLEBSIELLA PNEUMONIAE",
                "ENTEROBACTER ",
            ),
        ),
    ),
    evidence=(Evidence("esce", {"eligible": (FEP, CRO, CTX, *CEPHALOSPORINS[1:])}),),
    suffix="extended-spectrum cephalosporin resistant",
    plain_if_positive="ast_cre_status",
)

# A record gets the phenotype of the first positive rule in this order, else "base".
RULES = (CRE, MDR, OXACILLIN, VRE, ESCE)
BASE_PHENOTYPE = "base"
STATUS_COLUMNS = tuple(rule.status for rule in (CRE, ESCE, OXACILLIN, VRE, MDR))

# Text that marks a resistance designation made by the source itself,
# as (flag, qualifier, label fragment).
SOURCE_DESIGNATIONS = (
    ("source_designated_cre", "carbapenem_resistant", "CARBAPENEM RESISTANT"),
    ("source_designated_mrsa", "MRSA", "MRSA"),
    ("source_designated_vre", "vancomycin_resistant", "VANCO RESISTANT"),
)

# How the five published stratified categories are named on reports.
REPORT_SUFFIX = {
    "esce_r": "ESCE-R",
    "vancomycin_resistant": "VRE",
    "oxacillin_resistant": "MRSA",
    "oxacillin_susceptible": "MSSA",
}
MARKER_DRUGS = OXACILLIN.evidence[0].drugs["eligible"]
OVERALL_GROUPS = (S_AUREUS,)

# The two row families of the resistance table, as (rule, label).
MDRO_LABELS = ((CRE, "CRE"), (MDR, "MDR Pseudomonas aeruginosa"))


# --------------------------------------------------------------------------------------------------
# Rows for the tables above
# --------------------------------------------------------------------------------------------------
LABEL_COLUMNS = (
    "organism_source",
    "organism_standardized",
    "organism_reporting_group",
    "source_qualifier",
    "include_primary_summary",
    "mapping_status",
    "notes",
)
PAIR_COLUMNS = (
    "organism_reporting_group",
    "cohort_id",
    "antibiotic",
    "pair_order",
    "include_primary_dashboard",
    "review_status",
)
EXCLUSION_COLUMNS = (
    "organism_reporting_group",
    "cohort_id",
    "reporting_phenotype",
    "antibiotic",
    "exclusion_reason",
    "review_basis",
    "notes",
)
GROUP_COLUMNS = ("organism_reporting_group", "gram_stain_group")


def label_rows() -> list[tuple]:
    return [(*row[:4], 1, "reviewed", row[4]) for row in REVIEWED_LABELS]


def group_rows() -> list[tuple]:
    groups = sorted({row[2] for row in REVIEWED_LABELS})
    return [(g, "gram_positive" if g in GRAM_POSITIVE_GROUPS else "gram_negative") for g in groups]


def pair_rows() -> list[tuple]:
    panels = {(group, cohort): drugs for group, drugs in PANELS.items() for cohort in COHORTS} | CONTEXT_PANELS
    rows = []
    for (group, cohort), drugs in sorted(panels.items()):
        proposed = PROPOSED.get((group, cohort), ())
        for order, drug in enumerate(drugs, start=1):
            active = drug not in proposed
            rows.append((group, cohort, drug, order, int(active), "reviewed" if active else "proposed"))
    return rows


def exclusion_rows() -> list[tuple]:
    return list(EXCLUSIONS)
