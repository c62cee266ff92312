"""Word lists and patterns of the extraction rules. Results depend on each of them."""

from __future__ import annotations

# Relation type, trigger, generic object and base confidence, in the order of the rules.
RELATION_PATTERNS = (
    ("foundry_dependency", r"\b(foundr(?:y|ies)|wafer fabrication|semiconductor fabrication|semiconductor wafers?)\b", "foundry capacity or service", 0.72),
    ("packaging_or_assembly_dependency", r"\b(advanced packaging|assembly|testing|outsourced semiconductor assembly|osat)\b", "packaging, assembly, or test provider", 0.70),
    ("manufacturing_dependency", r"\b(contract manufacturer|manufacturing partner|outsourced manufacturing|fabrication|manufacturing agreement|tolling agreement)\b", "manufacturing provider", 0.68),
    ("cloud_or_hosting_dependency", r"\b(cloud|hosting|hosted by|cloud services agreement|aws|azure|google cloud|gcp)\b", "cloud or hosting provider", 0.68),
    ("data_center_dependency", r"\b(data centers?|colocation|compute capacity|server capacity|gpu capacity|data center lease|colocation agreement|capacity agreement)\b", "data center or compute capacity", 0.68),
    ("power_or_utility_dependency", r"\b(power|electricity|utility|energy supply|cooling|natural gas|uranium|fuel|power purchase agreements?|ppas?|energy services agreement|interconnection agreement|transportation suppliers?)\b", "power, utility, or cooling supply", 0.65),
    ("network_or_interconnection_dependency", r"\b(network|interconnection|peering|carrier|bandwidth|ethernet)\b", "network or interconnection provider", 0.62),
    ("customer_dependency", r"\b(customer concentration|major customers?|large customers?|significant customers?|customers? accounted for|customer accounts?)\b", "major customer(s)", 0.70),
    ("supplier_dependency", r"\b(suppliers?|vendors?|third[- ]party|sole source|limited number|supply agreement|purchase agreement|master services agreement|services agreement|procurement agreement|purchas(?:e|es|ed|ing)|procure(?:s|d|ment|ments)?|source(?:s|d|ing)?|obtain(?:s|ed|ing)?)\b", "supplier(s)", 0.66),
    ("distribution_or_channel_dependency", r"\b(distributors?|resellers?|channel partners?|app store|distribution agreement|reseller agreement)\b", "distribution channel partner", 0.62),
    ("strategic_partner", r"\b(strategic partnership|strategic partner|strategic collaboration|collaboration agreement|alliance|joint development|lead partner|co-developer|strategic collaboration agreement)\b", "strategic partner", 0.70),
    ("co_investment", r"\b(joint investment|co-investment|joint venture|jointly invest)\b", "co-investment partner", 0.70),
    ("asset_acquisition", r"\b(acquired assets? from|acquisition of assets? from|purchased assets? from|asset purchase agreement)\b", "asset seller", 0.76),
    ("asset_divestiture", r"\b(sold assets? to|divested assets? to|asset sale agreement|disposed of assets? to)\b", "asset buyer", 0.76),
    ("business_combination", r"\b(acquired|acquisition of|business combination|merger agreement|merged with)\b", "acquisition or merger counterparty", 0.74),
    ("strategic_investment", r"\b(strategic investment in|invested in|equity investment in|purchased .* equity)\b", "investment counterparty", 0.72),
    ("licensing_dependency", r"\b(license|license agreement|licensed technology|intellectual property|ip rights)\b", "licensor or licensed technology", 0.62),
    ("facility_or_geographic_exposure", r"\b(taiwan|china|export controls?|facility|geographic|earthquake|logistics)\b", "facility or geography", 0.58),
    ("subsidiary_or_control", r"\b(subsidiar(?:y|ies)|wholly owned|majority owned|controlled by|parent company|ownership interest|affiliates?)\b", "subsidiary or affiliate", 0.66),
    ("concentration_risk", r"\b(concentration|limited number|single supplier|single customer|substantial portion)\b", "concentrated dependency", 0.68),
)

# Markers of modality, in the order in which they are tried.
FORWARD_MARKERS = ("plan to", "expect to", "intend to", "will need", "future")
STRATEGIC_MARKERS = ("strategic partnership", "strategic partner", "strategic collaboration", "lead partner", "co-developer")
RISK_MARKERS = ("may adversely affect", "could adversely affect", "may be adversely affected", "could be adversely affected", "risk", "if we are unable", "if our suppliers", "if any supplier")
CURRENT_MARKERS = ("we rely", "we depend", "we are dependent", "we use", "we purchase", "we obtain", "we source", "we have entered into", "entered into", "contract with", "contracts with", "agreement with", "lease")
HISTORICAL = r"\b(previously|formerly|historically|during fiscal \d{4})\b"
TEMPORAL_SCOPE = r"\b(20\d{2}|fiscal\s+20\d{2}|quarter|annual|multi-year|long-term)\b"

# A name with a legal form, and what is no product.
LEGAL_NAME = r"\b([A-Z][A-Za-z0-9&.\-]*(?:\s+[A-Z][A-Za-z0-9&.\-]*){0,8}\s*,?\s+(?:Inc\.?|Incorporated|Corporation|Corp\.?|Company|Co\.?|Ltd\.?|Limited|plc|PLC|N\.V\.|S\.A\.|LLC|Holdings)(?:,\s*Ltd\.?)?)\b"
PRODUCT = r"\b(?:purchase|purchases|purchased|procure|obtain|source)\s+(.{2,80}?)\s+from\b"
GENERIC_PRODUCTS = ("product", "products", "capacity", "any specific capacity")
NO_PRODUCT = ("from ", "purchase", "commitment", "obligation", "proceed", "competitor", "customer", "directly", "indirectly")
SELF_REFERENCE = r"\b(we|our|us|the company)\b"

# Words that a question's search terms leave out, and facets: pattern, then the phrases searched for.
QUESTION_STOPWORDS = (
    "a", "an", "and", "answer", "as", "assuming", "based", "basing", "be", "best", "by", "calculate", "can", "clearly", "compute", "considering",
    "details", "did", "do", "end", "following", "from", "give", "have", "help", "how", "in", "information", "is", "it", "judgment", "much", "of",
    "only", "outlined", "perspective", "please", "primarily", "provided", "question", "reasonable", "referencing", "respond", "response", "shown",
    "state", "stated", "the", "this", "to", "using", "utilizing", "was", "we", "what", "when", "within", "year", "you",
)
QUERY_FACETS = (
    (r"inventory turnover", ("cost of goods sold cost of sales cost of revenue", "inventory inventories")),
    (r"days payable|\bdpo\b", ("accounts payable trade payables", "cost of goods sold cost of sales", "inventory inventories")),
    (r"ebitda", ("operating income income from operations", "depreciation amortization", "revenue net sales")),
    (r"asset turnover", ("revenue net sales", "total assets")),
    (r"working capital", ("total current assets", "total current liabilities")),
    (r"return on assets|\broa\b", ("net income net loss", "total assets")),
    (r"\bcagr\b", ("revenue net sales total revenues",)),
    (r"capex|capital expenditure", ("capital expenditures purchases property plant equipment",)),
    (r"cost of goods sold|\bcogs\b", ("cost of goods sold cost of sales cost of revenue",)),
    (r"cash dividends|dividends.*paid", ("cash dividends dividends paid payments of dividends",)),
    (r"net (?:ar|accounts receivable)", ("accounts receivable net receivables",)),
    (r"net (?:ppne|pp&e)|net property,? plant", ("property plant equipment net pp&e",)),
    (r"cash flow from operating activities", ("net cash provided by operating activities",)),
    (r"depreciation and amortization|\bd&a\b", ("depreciation amortization",)),
    (r"net income", ("net income net earnings net loss",)),
    (r"total current assets", ("total current assets",)),
    (r"total current liabilities", ("total current liabilities",)),
    (r"total assets", ("total assets",)),
    (r"accounts payable", ("accounts payable trade payables",)),
    (r"inventor(?:y|ies)", ("inventory inventories",)),
    (r"operating income", ("operating income income from operations operating profit",)),
    (r"revenue", ("revenue net sales total revenues",)),
)

# The canonical relation of each raw type, its family, and whether the subject is the source.
CANONICAL_TYPES = {
    "foundry_dependency": ("supplies_to", "supply_chain", False),
    "packaging_or_assembly_dependency": ("supplies_to", "supply_chain", False),
    "supplier_dependency": ("supplies_to", "supply_chain", False),
    "customer_dependency": ("supplies_to", "supply_chain", True),
    "strategic_partner": ("partners_with", "strategic", True),
    "licensing_dependency": ("licenses_to", "strategic", False),
}
# Groups of industries by the first pattern that a role has.
INDUSTRY_GROUPS = (
    (r"power|cooling|generation|grid", "Power & thermal"),
    (r"data.?center|colocation|server|network|optical|edge_cloud", "Data-center infrastructure"),
    (r"foundry|semiconductor|accelerator|memory|semicap|chip|compute", "Semiconductors & compute"),
    (r"cloud|hyperscaler|database|platform", "Cloud & platforms"),
    (r"software|observability|ai_software", "AI software"),
)
