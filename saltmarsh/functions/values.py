"""Fixed values that results depend on: word lists, markers, priorities and names, in their natural order."""

# Preference of a source's abstract
ABSTRACT_PRIORITY = {"semantic_scholar": 6, "europe_pmc": 5, "pubmed": 4, "openalex": 3, "crossref": 2, "core": 1, "lens": 1, "dimensions": 1}
# Prefixes taken off a DOI, in this order, each once
DOI_PREFIXES = ["https://doi.org/", "http://doi.org/", "doi:"]
# English function words
STOP_WORDS = ["the", "and", "of", "to", "in", "for", "with", "from", "that", "this", "is", "are", "was", "were", "on", "as", "by", "an", "be", "or", "we", "at", "which", "can", "have", "has", "these", "our", "their", "using"]
# Signs of a page that is no article
NON_ARTICLE_MARKERS = ["cookie", "captcha", "sign in", "log in", "access through your institution", "buy article", "purchase", "for rights and permissions", "404", "page not found", "javascript is disabled", "not authorized", "institutional access"]
# Signs of boilerplate
BOILERPLATE_MARKERS = ["click here to view figure", "article metrics", "cite this article", "journal impact factor", "journal is indexed in", "copy the following to cite", "share"]
# UTF-8 read as Latin text
MOJIBAKE = "(â€|â€“|â€™|Â°|Â)"
# what each of its matches begins with
MOJIBAKE_STARTS = ["â€", "Â"]
# Signs of an error body
ERROR_MARKERS = ["access denied", "captcha", "enable javascript", "page not found", "error", "temporarily unavailable", "forbidden"]
# Rank of labels
LABEL_RANK = {"complete_full_text": 6, "partial_full_text": 5, "abstract_only": 4, "title_only": 3, "metadata_only": 2, "non_article": 1, "failed": 0}
# Names that are no additives
EXCLUDED_COMPOUNDS = ["ascorbic acid", "vitamin c", "vitamin e", "alpha-tocopherol", "quercetin", "catechin", "epicatechin", "gallic acid", "resveratrol", "glutathione", "superoxide dismutase", "sod", "catalase", "curcumin", "lycopene", "beta-carotene", "retinol", "green tea", "ginger", "moringa", "cbd"]
# Greek letters by name
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "ζ": "zeta", "η": "eta", "θ": "theta", "ι": "iota", "κ": "kappa", "λ": "lambda", "μ": "mu", "ν": "nu", "ξ": "xi", "ο": "omicron", "π": "pi", "ρ": "rho", "σ": "sigma", "τ": "tau", "υ": "upsilon", "φ": "phi", "χ": "chi", "ψ": "psi", "ω": "omega"}
# Short names of additives
ABBREVIATIONS = {"bht": "butylated hydroxytoluene", "bha": "butylated hydroxyanisole", "dppd": "N,N'-diphenyl-p-phenylenediamine", "pana": "phenyl-alpha-naphthylamine", "zddp": "zinc dialkyldithiophosphate", "tbhq": "tert-butylhydroquinone", "dtbp": "2,6-di-tert-butylphenol", "mbp": "2,2'-methylenebis(4-methyl-6-tert-butylphenol)", "odpa": "octylated diphenylamine"}
# Locators in order of preference
LOCATOR_PRIORITY = ["pmc_xml", "epmc_xml", "unpaywall", "semantic_scholar", "core", "crossref_link"]
# Roles of interest and direct evidence
ROLE_PATTERN = r"\baminic\b|\bamine(?:[- ]type)? antioxidant|\baromatic amine|\barylamine|\bdiarylamine"
EVIDENCE_PATTERN = r"antioxid|oxidation inhib|inhibit(?:s|ed|ing)? (?:the )?oxid|oxidation stabil|radical[- ]trapp|scaveng|peroxyl|induction period|chain break|rate constant|\bRTA\b"
DEFAULT_EXCLUSION = "not supported as a conventional aminic antioxidant by name/structure in this automated audit"
# An abstract within a text, a compounds object within an answer, a figure's placeholder
ABSTRACT_PATTERN = r"(?is)\babstract\b\s*[:\-]?\s*(.{120,2500}?)(?:\n\n|\bkeywords?\b|\bintroduction\b)"
COMPOUNDS_PATTERN = r'(?s)(\{[^{}]*"compounds"\s*:\s*\[.*?\]\s*\})'
FIGURE_MARKER = "click here to view figure"
FIGURE_PATTERN = r"(?s)\bfigure\s+\d+\b.{0,120}click here to view figure"

NOT_FOUND, MISSING = "NOT FOUND", "N/A"
COMPLETE_CHARS, PARTIAL_CHARS, ABSTRACT_CHARS = 4000, 1200, 120
SCORE_THRESHOLD, PROMPT_ABSTRACT_CHARS = 6, 2000
CHUNK_CHARS, CHUNK_OVERLAP = 10_000, 800
NAME_SIMILARITY, TITLE_SIMILARITY = 0.72, 0.60
SOURCES = ["openalex", "semantic_scholar", "crossref", "pubmed", "europe_pmc", "core", "lens"]
