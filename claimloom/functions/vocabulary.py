"""Word lists, labels and patterns that results depend on."""

# Section headings in the order in which they are tried.
SECTION_HEADINGS = ["Background of the Merger", "Reasons for the Merger", "Opinion of", "Financing", "Interests of Directors and Executive Officers", "No-Boundary Cycle Marker"]
UNKNOWN_SECTION = "unknown_section"
BACKGROUND = "Background of the Merger"

# Form types and the process scope each stands for.
PROCESS_SCOPES = {
    "DEFM14A": "target_full_proxy",
    "PREM14A": "target_full_proxy",
    "SC TO-T": "bidder_partial_schedule_to",
    "SC TO-T/A": "bidder_partial_schedule_to",
    "DEFA14A": "amendment_only",
    "DEFA14A/A": "amendment_only",
}

# Coverage obligations as (expected claim type, label, importance), in sequence.
OBLIGATIONS = [
    ("event", "Sales process initiation", "required"),
    ("participation_count", "Bidder count at IOI stage", "required"),
    ("participation_count", "Bidder count at first round", "important"),
    ("event", "Final round bid receipt", "required"),
    ("event", "Exclusivity grant", "required"),
    ("actor", "Target board", "required"),
    ("actor", "Financial advisor for target", "required"),
    ("actor", "Legal advisor for target", "required"),
    ("bid", "Final bid price", "required"),
    ("actor_relation", "Buyer group composition", "important"),
]
CLAIM_TYPES = ["actor", "event", "bid", "participation_count", "actor_relation"]

# The vocabulary of labels that name no particular bidder.
COUNT_WORDS = [
    "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten",
    "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty",
    "couple", "several", "multiple", "various", "numerous", "many", "some", "certain",
]
BIDDER_NOUNS = [
    "party", "parties", "bidder", "bidders", "buyer", "buyers", "entity", "entities",
    "firm", "firms", "purchaser", "purchasers", "sponsor", "sponsors", "participant", "participants",
]
GENERIC_LABELS = [
    "potential bidder", "potential bidders", "potential buyer", "potential buyers",
    "prospective bidder", "prospective bidders", "prospective buyer", "prospective buyers",
    "interested party", "interested parties", "potentially interested party", "potentially interested parties",
    "financial buyer", "financial buyers", "strategic buyer", "strategic buyers",
    "financial sponsor", "financial sponsors", "private equity firm", "private equity firms",
    "other party", "other parties", "other bidder", "other bidders", "other buyer", "other buyers",
]
BIDDER_MODIFIERS = [
    "potential", "potentially", "interested", "prospective", "financial", "private", "equity",
    "strategic", "other", "remaining", "additional", "qualified", "initial",
]

# Phrases of a quote that support each relation.
RELATION_PHRASES = {
    "acquisition_vehicle_of": ["acquisition vehicle", "vehicle of"],
    "member_of": ["member of", "part of", "together we refer", "who together", "together as"],
    "affiliate_of": ["affiliate of", "affiliated with"],
    "controls": ["controls", "controlled by", "purchased by", "acquired by", "owned by"],
    "advises": ["advisor", "adviser", "advises"],
    "finances": ["financing", "finances", "provide capital", "capital required", "financing letter"],
    "supports": ["support", "supports", "guarantee", "guarantees"],
    "voting_support_for": ["voting agreement", "support agreement", "vote in favor", "agreed to vote", "voting and support"],
    "rollover_holder_for": ["rollover", "rolled", "contribute", "retain equity", "equity rollover"],
    "committee_member_of": ["committee", "member", "composed of", "appointed", "added"],
    "recused_from": ["recuse", "recused", "exclude", "excluded", "not participate"],
}
# Terms that put a quote in the context of a bid.
BID_TERMS = ["bid", "offer", "proposal", "submitted", "proposed", "indication of interest"]

# Phrases that show a boundary, by subtype, in the order in which subtypes are tried.
BOUNDARY_PHRASES = [
    ("advancement_admitted", [
        "proceed to the final round", "request for submission of offers", "submitted proposals expressing their continued interest",
        "draft of the merger agreement was distributed", "intended to enter into a merger agreement", "best and final",
        "invited to submit final", "advanced to the next round",
    ]),
    ("exclusivity_grant", ["exclusivity"]),
    ("merger_agreement_executed", ["executed the merger agreement", "entered into the merger agreement"]),
    ("ioi_submitted", ["submitted an indication of interest", "submitted a non-binding indication"]),
    ("first_round_bid", ["submitted a first round bid", "first round bid"]),
    ("final_round_bid", ["submitted a final round bid", "final round bid"]),
]

# What makes a row eligible for the projection.
PROJECTION_ROLES = ["bid_submitter", "offeror"]
PROJECTION_OBSERVABILITY = ["named", "anonymous_handle"]
PROJECTION_KINDS = ["organization", "person", "group", "vehicle"]
PROJECTION_RULE = "actor_cycle_has_source_backed_bid"
PROJECTION_NAME = "bidder_cycle_baseline_v1"

# Parts of names that mark a secret, and the numbers of deals that costs are projected to.
SECRET_KEY_PARTS = ["api_key", "authorization", "bearer", "credential", "password", "private_key", "refresh_token", "secret", "access_token"]
DEAL_COUNTS = [3, 9, 30, 400, 800]

# Form types of filings with a narrative, and those of tender offers, whose exhibit holds it.
PRIMARY_FORMS = ["DEFM14A", "PREM14A", "SC TO-T", "SC TO-T/A", "S-4", "S-4/A"]
TENDER_FORMS = ["SC TO-T", "SC TO-T/A"]
EXCLUDED_FORMS = ["425"]
OFFER_EXHIBIT = r"^EX-99\.\(?A\)?\(?1\)?\(?A\)?"

# Number words of participation counts.
NUMBER_WORDS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10,
    "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20,
    "twenty-four": 24, "twenty-five": 25, "twenty-seven": 27, "thirty-five": 35, "fifty": 50, "fifty-eight": 58,
}

# What the typed fields of a payload's claims may hold.
CONFIDENCES = ["low", "medium", "high"]
ACTOR_KINDS = ["organization", "person", "group", "vehicle", "cohort", "committee"]
OBSERVABILITIES = ["named", "anonymous_handle", "count_only"]
EVENT_TYPES = ["process", "bid", "transaction"]
EVENT_SUBTYPES = [
    "contact_initial", "nda_signed", "ioi_submitted", "first_round_bid", "final_round_bid", "exclusivity_grant", "merger_agreement_executed", "withdrawn_by_bidder",
    "excluded_by_target", "non_responsive", "cohort_closure", "advancement_admitted", "advancement_declined", "rollover_executed", "financing_committed",
]
EVENT_ROLES = [
    "target", "bid_submitter", "potential_buyer", "group_vehicle", "group_member", "advisor_for_target", "advisor_for_bidder", "equity_financing_source",
    "debt_financing_source", "support_shareholder", "rollover_holder", "offeror", "acquisition_sub", "sender", "recipient",
]
BID_STAGES = ["initial", "revised", "final", "unspecified"]
PROCESS_STAGES = ["contacted", "nda_signed", "ioi_submitted", "first_round", "final_round", "exclusivity"]
ACTOR_CLASSES = ["financial", "strategic", "mixed"]
COUNT_QUALIFIERS = ["exact", "approximate", "lower_bound", "upper_bound", "range"]
RELATION_TYPES = ["member_of", "affiliate_of", "controls", "acquisition_vehicle_of", "advises", "finances", "supports", "voting_support_for", "rollover_holder_for", "committee_member_of", "recused_from"]
