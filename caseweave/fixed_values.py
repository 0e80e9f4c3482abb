"""Word lists, patterns, templates and reference rows.

These decide results, so they are stated here once, plainly.  Everything is a
default; each operator takes its own value as a parameter.
"""

from __future__ import annotations

# --- text quality -----------------------------------------------------------

MIN_TEXT_LENGTH = 5
STOP_TEXTS = ("open", "other", "accepted", "unknown", "none", "na", "n/a")
DEFAULT_REQUEST_TYPE = "Issue"
NO_TEXT_NOTE = "No detailed text provided."

# Phrases that open a machine-written tail; the tail runs to the end of the text.
# ``True`` marks phrases that start a word and allow any white space between words.
BOILERPLATE_PHRASES = (
    ("case transferred", True),
    ("case is a duplicate", True),
    ("customer may follow up", False),
)

# Characters the Unicode standard calls white space.
UNICODE_SPACES = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
        0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# A letter after one of these starts a new word in title case.
TITLE_DELIMITERS = "\t\n\x0b\f\r []{}()/|\\<>!?@\"^#$&~_,.:;*%+-"

IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "gif")

# --- cohort, search and batch sizes -----------------------------------------

COHORT_PER_STRATUM = 500
NEIGHBOURS = 5
MAX_DISTANCE = 0.50
REFINE_BATCH = 200
ANALYSIS_POOL = 1000
GENERATION = {"temperature": 0.0, "max_output_tokens": 160}

SEVERITIES = ("low", "medium", "high")
DEFAULT_SEVERITY = "medium"

# --- prompt templates -------------------------------------------------------

PROMPT_THEMES = (
    "Illegal Parking", "Abandoned Vehicle", "Garbage Overflow", "Illegal Dumping",
    "Garbage Collection", "Debris Removal", "Mold/Mildew", "Building Maintenance",
    "Tree Maintenance", "Vandalism", "Noise Complaint", "Flooding",
    "Utility Complaint", "Employee Conduct",
)

TRIAGE_PROMPT = (
    "Complaint Summary: {summary} | You are a city 311 triage bot. Respond with ONLY valid "
    "JSON on one line using double quotes. Do not add markdown, code fences, or any extra "
    'text. The JSON must have three keys: {{"theme":"","severity":"","suggested_action":""}}. '
    'Choose exactly ONE theme from: {themes}. Severity must be one of "low","medium","high". '
    "Write suggested_action as ONE imperative sentence. Internal ID: {id}"
)

EMBED_TEXT = "Theme: {theme}. Summary: {summary}"

REFINE_PROMPT = (
    "Policy: {title}\nSnippet: {snippet}\nComplaint: {summary}\nOriginal action: {action}\n"
    "Rewrite the action to strictly follow the policy. Respond with one imperative sentence only."
)

PHOTO_PROMPT = (
    "Summarize this 311 complaint photo in one concise sentence (<= 30 words). "
    "Return only the sentence."
)

# --- labels used in reports -------------------------------------------------

TEXT_COHORT = "No-AI (Text-only)"
ALL_COHORT = "With AI (Text+Image)"

# --- reference rows ---------------------------------------------------------

LABELS = PROMPT_THEMES + (
    "Bulky Items", "Encampment", "Human/Animal Waste", "Street/Sidewalk Defect",
    "Streetlight Out", "Hazardous/Medical Waste", "Illegal Postings",
)

# policy_id, title, chunk_text, source_url, target_theme
POLICIES = (
    ("PARK_HYDRANT", "Fire Hydrants",
     "Do not stop or park within 15 feet of a fire hydrant (CA Vehicle Code §22514).",
     "https://law.justia.com/codes/california/code-veh/division-11/chapter-9/section-22514/",
     "Illegal Parking"),
    ("PARK_DAYLIGHT", "Crosswalk Daylighting (AB 413)",
     "Do not park within 20 feet of the approach side of any crosswalk—marked or unmarked—per "
     "California AB 413.",
     "https://www.sfmta.com/press-releases/press-release-sfmta-acting-transportation-director-"
     "announces-plan-fair-enforcement-californias-daylighting-law",
     "Illegal Parking"),
    ("PARK_72HR", "72-Hour Rule",
     "A vehicle may not remain parked in the same spot on a public street for more than 72 "
     "hours; may be warned, cited, or towed.",
     "https://www.sfmta.com/blog/san-francisco-parking-tips-72-hour-rule",
     "Abandoned Vehicle"),
    ("ILLEGAL_DUMP", "Illegal Dumping",
     "Illegal dumping in the public right of way is prohibited; report to 311 for cleanup and "
     "enforcement.",
     "https://www.sf.gov/report-illegal-dumping-activity",
     "Illegal Dumping"),
    ("GRAFFITI_30D", "Graffiti Removal (30 days)",
     "Private property owners must abate graffiti within 30 days of notice under Public Works "
     "Code Article 23.",
     "https://sfpublicworks.org/services/graffiti-private-property",
     "Vandalism"),
    ("NOISE_LIMITS", "Noise Limits (Police Code Art. 29)",
     "Residential interior nighttime noise limits (10pm–7am) apply; permits required for night "
     "work. See Article 29 guidelines.",
     "https://www.sf.gov/sites/default/files/2024-02/"
     "21_CACOSF_2023_Article29RegulationofNoiseGuidelines.pdf",
     "Noise Complaint"),
    ("SIDEWALK_RESP", "Sidewalk Maintenance (PW Code §706)",
     "Property owners are responsible for maintaining adjacent sidewalks and addressing "
     "hazards; failures may be deemed a public nuisance.",
     "https://sfpublicworks.org/services/permits/sidewalk-repair",
     "Street/Sidewalk Defect"),
    ("ILLEGAL_POST", "Illegal Postings",
     "Posting signs on public property is restricted; illegal postings may be removed and "
     "fined. Limited posting allowed per Article 5.6.",
     "https://sfpublicworks.org/services/posting-signs",
     "Illegal Postings"),
    ("STREETLIGHT_RPT", "Streetlight Outage",
     "Report broken or dark streetlights to 311; SFPUC maintains most streetlights in San "
     "Francisco.",
     "https://www.sf.gov/report-problem-streetlight",
     "Streetlight Out"),
    ("BULKY_ITEMS", "Bulky Item Pickup (Recology)",
     "Residents get limited no-charge bulky item pickups; schedule with Recology and place "
     "items at curb without blocking sidewalks.",
     "https://www.recology.com/recology-san-francisco/bulky-items/",
     "Bulky Items"),
    ("HAZ_MED_WASTE", "Needles/Medical Waste",
     "Do not handle sharps or medical waste; report via 311 for safe removal (typical response "
     "12–24 hours).",
     "https://www.sf.gov/request-street-or-sidewalk-cleaning",
     "Hazardous/Medical Waste"),
    ("HUMAN_ANIMAL_WASTE", "Human/Animal Waste Cleanup",
     "Report human or animal waste via 311 for steam cleaning and disinfection (typical "
     "response 12–24 hours).",
     "https://www.sf.gov/request-street-or-sidewalk-cleaning",
     "Human/Animal Waste"),
)
