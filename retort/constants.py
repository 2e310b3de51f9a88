"""Fixed values.

Everything in this module must equal the original pipeline's values for the
results to match: keyword dictionary, inline sample compounds, the SMILES
token pattern and default vocabulary, the patent text patterns and keyword
rules, the gate tag sets and the one-hot category lists. They are kept here
as plain text in their natural order. Operators take them as default
arguments so callers can pass their own vocabularies.
"""

# --- FIXED VALUES: application keyword dictionary (category order matters:
# the first category with a matching keyword wins) -------------------------
APPLICATION_MAPPING = [
    ("pharmaceutical", [
        "drug", "medicine", "therapeutic", "antibiotic", "antiviral",
        "anticancer", "analgesic", "antidepressant", "antifungal",
        "anti-inflammatory", "antihypertensive", "diabetes", "cardiovascular",
        "neurological", "psychiatric", "oncology", "immunosuppressant",
    ]),
    ("industrial", [
        "solvent", "catalyst", "reagent", "intermediate", "polymer",
        "plasticizer", "stabilizer", "lubricant", "adhesive", "coating",
        "chemical manufacturing", "industrial process", "extraction",
        "ethanol", "acetone", "toluene", "acetic acid",
    ]),
    ("agricultural", [
        "pesticide", "herbicide", "fungicide", "insecticide", "fertilizer",
        "plant growth", "crop protection", "veterinary", "animal health",
        "glyphosate", "atrazine",
    ]),
    ("consumer", [
        "cosmetic", "fragrance", "flavor", "food additive", "preservative",
        "personal care", "household", "detergent", "cleaning", "shampoo",
        "benzoic acid", "sorbic acid", "sodium lauryl sulfate", "limonene", "vanillin",
    ]),
    ("materials", [
        "semiconductor", "electronic", "optical", "magnetic", "ceramic",
        "composite", "nanomaterial", "crystal", "metallic", "polyethylene", "silicon dioxide",
    ]),
    ("energy", [
        "fuel", "battery", "solar", "photovoltaic", "fuel cell",
        "energy storage", "biofuel", "renewable energy", "lithium cobalt oxide",
    ]),
]

# --- FIXED VALUES: inline sample compounds (smiles, name, applications) -----
INDUSTRIAL_SAMPLES = [
    ("CCCCCCCCCCCCCCCCCC(=O)O", "Stearic Acid", ["surfactant", "detergent", "industrial"]),
    ("CC(C)(C)c1ccc(O)cc1", "Butylated Hydroxytoluene (BHT)", ["antioxidant", "stabilizer", "industrial"]),
    ("CCCCO", "n-Butanol", ["solvent", "chemical_intermediate", "industrial"]),
    ("CC(=O)OCC=C", "Vinyl Acetate", ["monomer", "polymer_precursor", "industrial"]),
    ("c1ccccc1C(=O)OOC(=O)c1ccccc1", "Benzoyl Peroxide", ["initiator", "polymerization", "industrial"]),
    ("CN(C)C=O", "Dimethylformamide (DMF)", ["solvent", "reagent", "industrial"]),
    ("C1CCCCC1", "Cyclohexane", ["solvent", "raw_material", "industrial"]),
    ("OCCO", "Ethylene Glycol", ["antifreeze", "solvent", "polyester_precursor", "industrial"]),
]

PHARMA_SAMPLES = [
    ("CC(=O)Oc1ccccc1C(=O)O", "Aspirin", ["analgesic", "anti-inflammatory", "pharmaceutical"]),
    ("CN1C=NC2=C1C(=O)N(C(=O)N2C)C", "Caffeine", ["stimulant", "pharmaceutical", "beverage_additive"]),
    ("CC(C)NCC(O)c1ccc(O)c(CO)c1", "Salbutamol", ["bronchodilator", "asthma_treatment", "pharmaceutical"]),
    ("CN(C)CCc1c[nH]c2ccc(C[C@H]3COC(=O)N3C)cc12", "Sumatriptan", ["migraine_treatment", "serotonin_agonist", "pharmaceutical"]),
    ("COc1ccc2[nH]c(CCN(C)C)c3c2c1C(=O)N3", "Melatonin", ["sleep_aid", "hormone_supplement", "pharmaceutical"]),
    ("CN1CCN(CC1)c1c(F)cc2c(c1F)c(=O)c(C(=O)O)cn2C2CC2", "Ciprofloxacin", ["antibiotic", "fluoroquinolone", "pharmaceutical"]),
    ("CC(C)(O)CnC(C)(C)c1ccc(O)cc1O", "Terbutaline", ["bronchodilator", "asthma_treatment", "pharmaceutical"]),
    ("CN1C2CCC1C(C(C2)OC(=O)C(CO)c3ccccc3)O", "Atropine", ["anticholinergic", "mydriatic", "pharmaceutical"]),
    ("CCN(CC)CCNC(=O)c1c(N)ccc(Cl)c1", "Procainamide", ["antiarrhythmic_agent", "cardiac_drug", "pharmaceutical"]),
    ("Cc1onc(c1)C(=O)Nc1ccc(cc1Cl)N1CCOCC1", "Rivastigmine analog structure", ["pharmaceutical_research", "cholinesterase_inhibitor_scaffold", "bioactive_molecule"]),
]

INDUSTRIAL_SOURCE = "patent_mining"
INDUSTRIAL_ID_FORMAT = "PATENT_SAMPLE_%06d"
PHARMA_SOURCE = "sample_pharmaceutical"
PHARMA_ID_FORMAT = "SAMPLE_DRUG_%06d"

# --- FIXED VALUES: SMILES tokeniser -----------------------------------------
# As published: the stereo-bond alternative asks for TWO backslashes, so a
# single backslash never matches and is silently dropped.
SMILES_PATTERN = (
    r"(\[[^\]]+]|Br?|Cl?|N|O|S|P|F|I|b|c|n|o|s|p|\(|\)|\.|=|#|-|\+|\\\\|\/|:|~|@|\?|>|\*|\$|\%[0-9]{2}|[0-9])"
)
# Repaired variant (single backslash) used for validation and graph tables.
SMILES_PATTERN_FIXED = (
    r"(\[[^\]]+]|Br?|Cl?|N|O|S|P|F|I|b|c|n|o|s|p|\(|\)|\.|=|#|-|\+|\\|\/|:|~|@|\?|>|\*|\$|\%[0-9]{2}|[0-9])"
)
DEFAULT_VOCAB = [
    "C", "N", "O", "S", "F", "P", "Cl", "Br", "I", "(", ")", "[", "]",
    "=", "#", ".", "c", "n", "o", "s", "1", "2", "3", "4", "5", "6",
    "7", "8", "9", "0", "-", "+", ":",
]
SPECIAL_TOKENS = ["<pad>", "<unk>", "<bos>", "<eos>"]
PAD_ID, UNK_ID, BOS_ID, EOS_ID = 0, 1, 2, 3

# --- FIXED VALUES: patent candidate-name patterns (case-insensitive) --------
CHEMICAL_PATTERNS = [
    r"\b\d+[a-z]?-[a-z\-]+-\d+[a-z]?\b",
    r"\b[A-Z][a-z]*(?:\s+[a-z]+)*\s+\d+\b",
    r"\b[A-Z]{2,}\s*-?\s*\d+\b",
    r"\b(?:compound|drug|molecule|chemical)\s+\w+\b",
    r"\b\w+(?:ine|anol|acid|ate|ide|ene|ane)\b",
]
CHEMICAL_INDICATORS = [
    r"compound\s+([A-Z]\w*)",
    r"formula\s+([A-Z][A-Za-z0-9]+)",
    r"(\w+(?:ine|anol|acid|ate|ide))\s+(?:was|is|can|has)",
    r"synthesis\s+of\s+(\w+)",
    r"preparation\s+of\s+(\w+)",
    r"active\s+ingredient\s+(\w+)",
    r"therapeutic\s+agent\s+(\w+)",
    r"drug\s+(\w+)",
    r"molecule\s+([A-Z]\w*)",
]

# --- FIXED VALUES: patent relevance filter ----------------------------------
PATENT_COUNTRY = "US"
PATENT_SINCE = "2018-01-01"
PATENT_ABSTRACT_SUBJECT = ["compound", "molecule", "chemical", "synthesis"]
PATENT_ABSTRACT_USE = ["treatment", "therapy", "use", "application", "method"]
PATENT_TITLE_WORDS = ["synthesis", "preparation", "compound", "derivative"]
PATENT_ABSTRACT_FIELDS = ["pharmaceutical", "industrial", "agricultural", "cosmetic"]
PATENT_CPC_PREFIXES = ["C07", "A61K", "A01N"]
PATENT_MIN_ABSTRACT = 250
PATENT_MIN_TITLE = 20

# --- FIXED VALUES: keyword fallback rules for patent text, in order ---------
PATENT_KEYWORD_RULES = [
    ("pharmaceutical_compound", ["drug", "pharmaceutical", "medicine", "therapeutic", "treatment"]),
    ("industrial_chemical", ["catalyst", "solvent", "industrial", "manufacturing", "process"]),
    ("agricultural_chemical", ["pesticide", "herbicide", "agricultural", "crop", "plant"]),
    ("material_component", ["polymer", "plastic", "coating", "material", "composite"]),
]
PATENT_DEFAULT_TAG = "general_chemical_compound"
UNKNOWN_APPLICATION = "unknown_application"
PATENT_SOURCE = "bigquery_ai_patents"
ARTIFACT_PREFIXES = ["translate to SMILES:", "SMILES:"]

# --- FIXED VALUES: gate tag sets per source ---------------------------------
UNKNOWN_CONFIRMED = "unknown_application_confirmed_by_gemini"
GATE_VARIANTS = {
    # variant: (tags on failure/unknown, tags appended on success)
    "chembl": (["bioactive", "pharmaceutical_candidate", "research_compound"],
               ["bioactive", "pharmaceutical_research"]),
    "drugbank": (["pharmaceutical", "drug", "therapeutic_agent"],
                 ["pharmaceutical", "drug"]),
}
CHEMBL_HINT = "bioactive, pharmaceutical research"
DRUGBANK_HINT = "pharmaceutical, drug"

# --- FIXED VALUES: rule-based fallback structure classes --------------------
STRUCTURE_BIOACTIVE = "potential_bioactive"
STRUCTURE_SMALL = "small_organic_compound"
STRUCTURE_GENERIC = "generic_organic_compound"
FALLBACK_EMPTY = "unknown_application_fallback"
ERROR_TAG_FORMAT = "error_%s_fallback"
PROMPT_CONTEXT_CHARS = 600

# --- FIXED VALUES: graph one-hot categories ---------------------------------
ATOM_TYPES = ["C", "N", "O", "S", "F", "P", "Cl", "Br", "I", "Unknown"]
HYBRIDIZATIONS = ["SP", "SP2", "SP3", "SP3D", "SP3D2", "Unknown"]
BOND_TYPES = ["SINGLE", "DOUBLE", "TRIPLE", "AROMATIC", "Unknown"]

# --- FIXED VALUES: model configuration ---------------------------------------
NUM_EXPERTS = 4
TOP_K = 2
LOAD_BALANCE_COEFF = 0.01
GATE_EPS = 1e-6
BATCH_SIZE = 32
SPLIT_SEED = 42
SPLIT_TEST_FRACTION = 0.2
SIMILARITY_THRESHOLD = 90

# --- Public element data (standard atomic weights; of the longest-lived isotope where there is none) --------
ATOMIC_WEIGHTS = {
    "H": 1.008, "He": 4.003, "Li": 6.94, "Be": 9.012, "B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999,
    "F": 18.998, "Ne": 20.18, "Na": 22.99, "Mg": 24.305, "Al": 26.982, "Si": 28.085, "P": 30.974, "S": 32.065,
    "Cl": 35.453, "Ar": 39.948, "K": 39.098, "Ca": 40.078, "Sc": 44.956, "Ti": 47.867, "V": 50.942, "Cr": 51.996,
    "Mn": 54.938, "Fe": 55.845, "Co": 58.933, "Ni": 58.693, "Cu": 63.546, "Zn": 65.38, "Ga": 69.723, "Ge": 72.63,
    "As": 74.922, "Se": 78.971, "Br": 79.904, "Kr": 83.798, "Rb": 85.468, "Sr": 87.62, "Y": 88.906, "Zr": 91.224,
    "Nb": 92.906, "Mo": 95.95, "Tc": 98.0, "Ru": 101.07, "Rh": 102.906, "Pd": 106.42, "Ag": 107.868, "Cd": 112.414,
    "In": 114.818, "Sn": 118.71, "Sb": 121.76, "Te": 127.6, "I": 126.904, "Xe": 131.293, "Cs": 132.905, "Ba": 137.327,
    "La": 138.905, "Ce": 140.116, "Pr": 140.908, "Nd": 144.242, "Pm": 145.0, "Sm": 150.36, "Eu": 151.964, "Gd": 157.25,
    "Tb": 158.925, "Dy": 162.5, "Ho": 164.93, "Er": 167.259, "Tm": 168.934, "Yb": 173.045, "Lu": 174.967, "Hf": 178.49,
    "Ta": 180.948, "W": 183.84, "Re": 186.207, "Os": 190.23, "Ir": 192.217, "Pt": 195.084, "Au": 196.967, "Hg": 200.592,
    "Tl": 204.38, "Pb": 207.2, "Bi": 208.98, "Po": 209.0, "At": 210.0, "Rn": 222.0, "Fr": 223.0, "Ra": 226.0,
    "Ac": 227.0, "Th": 232.038, "Pa": 231.036, "U": 238.029, "Np": 237.0, "Pu": 244.0, "Am": 243.0, "Cm": 247.0,
    "Bk": 247.0, "Cf": 251.0, "Es": 252.0, "Fm": 257.0, "Md": 258.0, "No": 259.0, "Lr": 262.0,
}

# --- SMILES bracket atom: isotope, symbol, chirality, hydrogens, charge, class
BRACKET_ATOM = r"^\[(\d{0,3})([A-Z][a-z]?|[a-z]{1,2}|\*)(@[A-Z]{2}\d{0,2}|@{1,2})?(H\d?)?([+-]+\d{0,2})?(:\d{1,9})?\]$"
