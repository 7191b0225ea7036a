"""Publication and study classification, in both generations of rules.

Rules are data: (result, condition) pairs that become one ``when`` chain or one
array of labels, so Catalyst evaluates them in a single pass over the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.text import collapse, has_any, label
from paperloom.schema import FORMAL_EVENTS, strings, text_of

# Phrases in titles that name a study design.
TITLE_DESIGNS = {
    "randomized_controlled_trial": r"\b(?:randomi[sz]ed\s+(?:controlled|clinical)\s+trial|cluster[- ]randomi[sz]ed(?:\s+controlled)?\s+trial|pragmatic\s+randomi[sz]ed(?:\s+controlled)?\s+trial)\b",
    "systematic_review": r"\bsystematic\s+review\b",
    "meta_analysis": r"\bmeta[- ]analys(?:is|es)\b",
    "scoping_review": r"\bscoping\s+review\b",
    "cohort_study": r"\b(?:prospective\s+|retrospective\s+)?cohort\s+stud(?:y|ies)\b",
    "case_control_study": r"\bcase[- ]control(?:led)?\s+stud(?:y|ies)\b",
    "cross_sectional_study": r"\bcross[- ]sectional\s+stud(?:y|ies)\b",
    "case_report": r"\bcase\s+(?:report|series)\b",
    "qualitative_study": r"\bqualitative\s+(?:study|research|analysis)\b",
    "animal_study": r"\b(?:animal|murine|mouse|mice|rat)\s+(?:study|model|experiment)\b",
    "in_vitro_study": r"\bin[- ]vitro\b",
    "computational_study": r"\bcomputational\s+(?:study|analysis|model(?:ing|ling)?)\b",
    "protocol": r"\b(?:study|trial|review|research)\s+protocol\b|\bprotocol\s+(?:for|of)\b|\bprotocol\s*:",
}
NO_RESULTS_YET = r"(?i)\b(?:rationale|protocol|trial\s+design|study\s+design|design\s+paper)\b"
GUIDELINE_TITLE = r"(?i)\bguidelines?\b"

# Provider labels that make a document formal, by its type.
CONFERENCE_LABELS = ("proceedings article", "conference paper", "conference proceedings")
JOURNAL_LABELS = ("journal article", "article", "research article")
PREPRINT_LABELS = ("preprint", "posted content")
FORMAL_TYPES = ("journal_article", "conference_paper", "protocol", "guideline")


def stable_types(types: Column) -> Column:
    """Each type once, whatever its case, in the spelling that sorts first; ordered by the folded text."""
    clean = F.filter(F.transform(strings(types), collapse), lambda t: t != "")
    pairs = F.array_sort(F.array_distinct(F.transform(clean, lambda t: F.struct(F.lower(t).alias("k"), t.alias("t")))))
    first = F.filter(pairs, lambda p, i: (i == 0) | (F.get(pairs, i - 1)["k"] != p["k"]))
    return F.transform(first, lambda p: p["t"])


# What a provider's label contains, or is, for each study design; and what it must not contain besides.
LABEL_CONTAINS = {
    "randomized_controlled_trial": ("randomized controlled trial", "randomised controlled trial"),
    "clinical_trial": ("clinical trial",),
    "systematic_review": ("systematic review",),
    "meta_analysis": ("meta analysis",),
    "scoping_review": ("scoping review",),
    "cohort_study": ("cohort study",),
    "case_control_study": ("case control",),
    "cross_sectional_study": ("cross sectional",),
    "qualitative_study": ("qualitative",),
    "observational_study": ("observational study",),
    "protocol": ("protocol",),
}
LABEL_IS = {"review": ("review", "review article"), "case_report": ("case report", "case reports")}
LABEL_LACKS = {"clinical_trial": ("randomized controlled trial", "randomised controlled trial", "protocol")}


def provider_designs(labels: Column) -> Column:
    """Study designs that provider labels state (P5), each once."""

    def of(x: Column) -> Column:
        said = {d: has_any(x, terms) for d, terms in LABEL_CONTAINS.items()} | {d: x.isin(*terms) for d, terms in LABEL_IS.items()}
        said |= {d: said[d] & ~has_any(x, terms) for d, terms in LABEL_LACKS.items()}
        return F.array_compact(F.array(*[F.when(c, F.lit(d)) for d, c in said.items()]))

    return F.array_distinct(F.flatten(F.transform(labels, of)))


def title_designs(title: Column) -> Column:
    """Study designs that a title states; a planned trial is no trial."""
    t = text_of(title)
    found = {k: t.rlike(f"(?i){p}") for k, p in TITLE_DESIGNS.items()}
    found["randomized_controlled_trial"] = found["randomized_controlled_trial"] & ~t.rlike(NO_RESULTS_YET)
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in found.items()]))


def classify(candidates: DataFrame) -> DataFrame:
    """Adds document_type, document_type_basis, study_designs and study_design_basis; makes provider types stable.

    What a provider says goes before what the source is, and that before the
    title, save that a preprint server makes a preprint whatever the title.
    """
    title = text_of(F.col("title"))
    rows = candidates.withColumn("provider_publication_types", stable_types(F.col("provider_publication_types")))
    rows = rows.withColumn("_labels", F.transform("provider_publication_types", label)).withColumn("_of_title", title_designs(title))
    stated = provider_designs(F.col("_labels"))
    rows = rows.withColumn("_of_provider", F.when(title.rlike(NO_RESULTS_YET), F.array_remove(stated, "randomized_controlled_trial")).otherwise(stated))

    any_label = lambda f: F.exists("_labels", f)
    source = label(F.col("source"))
    rules = [
        ("protocol", "PROVIDER_METADATA", any_label(lambda x: F.contains(x, F.lit("protocol")))),
        ("guideline", "PROVIDER_METADATA", any_label(lambda x: F.contains(x, F.lit("guideline")))),
        ("conference_paper", "PROVIDER_METADATA", any_label(lambda x: x.isin(*CONFERENCE_LABELS))),
        ("journal_article", "PROVIDER_METADATA", any_label(lambda x: x.isin(*JOURNAL_LABELS))),
        ("preprint", "PROVIDER_METADATA", any_label(lambda x: x.isin(*PREPRINT_LABELS))),
        ("preprint", "SOURCE_CLASS", F.coalesce(F.col("is_preprint"), F.lit(False))),
        ("protocol", "TITLE_EXPLICIT", title.rlike(f"(?i){TITLE_DESIGNS['protocol']}")),  # as in _of_title, which isn't made where only types are asked for
        ("guideline", "TITLE_EXPLICIT", title.rlike(GUIDELINE_TITLE)),
        ("conference_paper", "SOURCE_CLASS", source.isin("acl anthology", "pmlr")),
        ("journal_article", "SOURCE_CLASS", source.isin("pubmed", "europe pmc")),
    ]
    kind = F.struct(F.lit("unknown").alias("t"), F.lit("UNKNOWN").alias("b"))
    for t, b, c in reversed(rules):
        kind = F.when(c, F.struct(F.lit(t).alias("t"), F.lit(b).alias("b"))).otherwise(kind)
    provider, own = F.size("_of_provider") > 0, F.size("_of_title") > 0
    basis = F.when(provider & own, "PROVIDER_METADATA_AND_TITLE").when(provider, "PROVIDER_METADATA").when(own, "TITLE_EXPLICIT").otherwise("UNKNOWN")
    rows = rows.withColumn("_kind", kind).withColumns({"document_type": F.col("_kind.t"), "document_type_basis": F.col("_kind.b"), "study_designs": F.array_sort(F.array_union("_of_provider", "_of_title")), "study_design_basis": basis})
    return rows.drop("_labels", "_of_title", "_of_provider", "_kind")


def is_formal() -> Column:
    """Whether a classified observation shows a formal version: by its type, a label or an event."""
    preprint = F.coalesce(F.col("is_preprint"), F.lit(False)) | (F.col("document_type") == "preprint")
    named = F.exists(strings(F.col("provider_publication_types")), lambda t: label(t).isin(*CONFERENCE_LABELS, *JOURNAL_LABELS, "protocol", "guideline"))
    told = F.exists("events", lambda e: e["event_type"].isin(*FORMAL_EVENTS))
    return ~preprint & (F.col("document_type").isin(*FORMAL_TYPES) | named | F.coalesce(told, F.lit(False)))


# --- the older rules: one design, its tier and its evidence score

# What letters, protocols, people, animals and each subject are recognised by.
CORRESPONDENCE_TYPES = ("letter", "comment", "editorial", "news", "published erratum", "correction", "expression of concern", "retracted publication")
CORRESPONDENCE_TITLE = r"(?i)^\s*(?:re\s*:|reply\b|response to\b|comment on\b|letter to the editor\b|author response\b)"
PROTOCOL_TITLE = r"(?i)\b(?:(?:study|trial|pilot) protocol|protocol (?:for|of)|rationale and design|design and rationale|methods and design)\b"
PEOPLE = ("participant", "patient", "adult", "adolescent", "child", "athlete", "people", "human", "men", "women")
ANIMALS = ("animal model", "animal models", "mice", "mouse", "rats", "rat model", "murine", "rodent", "zebrafish", "drosophila", "dairy cow", "cattle", "bovine", "porcine", "swine")
SPORT = ("exercise", "athlete", "athletic", "sport", "soccer", "football", "basketball", "hockey", "resistance training", "strength training", "endurance training", "physical training", "training load", "strength and conditioning", "muscle", "hypertrophy", "plyometric", "neuromuscular", "physical performance", "aerobic conditioning", "blood flow restriction", "acl", "tendon", "gait", "kinematic", "musculoskeletal", "cartilage")
FITNESS = ("physical activity", "physical fitness", "cardiorespiratory fitness", "cardiopulmonary exercise", "cpet", "exercise", "sedentary", "step count", "steps per day", "walking", "muscular strength", "grip strength", "handgrip strength", "sarcopenia", "vo2max", "vo2 max", "aerobic capacity")
NUTRITION_ACTIVITY = ("athlete", "athletic", "sport", "exercise", "training", "sprint", "endurance", "strength", "muscle", "performance", "rehydration")
NUTRITION = ("nutrition", "nutrient", "diet", "protein", "amino acid", "carbohydrate", "glycogen", "creatine", "hydration", "rehydration", "fluid", "supplement", "energy availability", "relative energy deficiency", "red-s", "caffeine", "electrolyte")
CHAT_TECHNOLOGY = ("large language model", "llm", "chatbot", "conversational agent", "generative ai", "ai companion", "artificial intelligence companion", "machine companion", "replika", "character.ai", "kindroid", "human-ai", "human–ai")
CHAT_RELATION = ("companion", "companionship", "relationship", "relational", "attachment", "intimacy", "loneliness", "emotional support", "social support", "self-disclosure", "self disclosure", "parasocial", "anthropomorph", "dependency", "friendship", "social substitution", "well-being", "wellbeing", "mental health")
CLINICAL_JOURNALS = ("jama network open", "eclinicalmedicine", "bmc medicine", "bmj open", "communications medicine", "plos medicine", "bmj medicine", "lancet regional health", "new england journal of medicine", "the lancet", "jama", "the bmj", "annals of internal medicine", "nature medicine")
CLINICAL_TITLES = ("randomized controlled trial", "randomised controlled trial", "clinical trial", "systematic review", "meta-analysis", "meta analysis", "clinical guideline", "practice guideline", "consensus statement", "diagnosis", "screening", "treatment", "therapy", "prevention", "prognosis", "mortality", "morbidity", "adverse event", "disease risk", "public health")
CLINICAL_TYPES = ("randomized controlled trial", "controlled clinical trial", "clinical trial", "meta-analysis", "systematic review", "practice guideline", "guideline")

# Research directions, in their order, with their streams and terms.
DIRECTIONS = ("L1", "L2", "L3", "L4", "L5", "L6", "L7", "L8", "L9", "H1", "H2")
STREAM_DIRECTION = {
    "llm_l1_model_behavior": "L1", "llm_l2_context_inference": "L2", "llm_l3_retrieval_grounding": "L3", "llm_l4_memory_personalization": "L4",
    "llm_l5_agents_decision": "L5", "llm_l6_multi_agent": "L6", "llm_l7_systems_runtime": "L7", "llm_l8_training_architecture": "L8",
    "llm_l9_evaluation_measurement": "L9", "human_h1_llm_relationship": "H1", "human_h2_ai_hci": "H2", "llm_social": "H1",
}
MODEL_SIGNALS = ("large language model", "language model", "llm", "foundation model", "generative ai", "chatbot", "vision-language model")
AI_SIGNALS = (*MODEL_SIGNALS, "artificial intelligence", "human-ai", "human–ai", "ai system")
DIRECTION_TERMS = {
    "L1": ("instruction following", "sycophancy", "hallucination", "uncertainty", "calibration", "robustness", "jailbreak", "alignment", "model behavior", "model behaviour", "safety"),
    "L2": ("long context", "long-context", "context selection", "context compression", "test-time compute", "inference-time compute", "prompting", "in-context learning", "reasoning scaffold", "self-reflection", "self reflection", "reasoning verification", "answer verification", "self-verification"),
    "L3": ("retrieval", "reranking", "re-ranking", "query rewriting", "grounding", "citation verification", "evidence selection", "source authority", "rag", "retrieval-augmented", "retrieval augmented"),
    "L4": ("episodic memory", "semantic memory", "working memory", "continual memory", "memory consolidation", "forgetting", "temporal decay", "memory routing", "personalization", "personalisation", "user model", "longitudinal adaptation"),
    "L5": ("planning", "tool use", "tool-use", "action selection", "agent loop", "computer-use", "computer use", "browser agent", "autonomous execution", "long-horizon", "long horizon", "credit assignment", "agent safety"),
    "L6": ("multi-agent", "multi agent", "multiagent", "agent coordination", "role assignment", "task decomposition", "debate", "cooperation", "competition", "collective failure", "emergent behavior", "emergent behaviour"),
    "L7": ("serving", "inference system", "runtime", "orchestration", "state machine", "directed acyclic graph", "model context protocol", "mcp", "protocol", "sandbox", "observability", "latency", "reliability"),
    "L8": ("pretraining", "pre-training", "post-training", "post training", "sft", "reinforcement learning", "preference optimization", "preference optimisation", "distillation", "continual learning", "peft", "mixture of experts", "moe", "data curriculum", "synthetic data", "model architecture"),
    "L9": ("benchmark", "evaluation", "measurement", "contamination", "judge reliability", "llm-as-a-judge", "llm as a judge", "evaluation validity", "ecological validity", "metric", "test set"),
    "H1": ("attachment", "companionship", "companion", "anthropomorphism", "trust", "emotional dependence", "emotional dependency", "social connection", "well-being", "wellbeing", "persona", "relationship", "relational", "intimacy", "loneliness", "self-disclosure", "parasocial"),
    "H2": ("interaction design", "decision support", "human-ai interaction", "human–ai interaction", "human ai interaction", "agency", "collaboration", "appropriation", "trust", "user study", "human-computer interaction", "hci", "computer-supported cooperative work", "cscw"),
}


def paper_title() -> Column:
    return F.lower(text_of(F.col("title")))


def paper_text() -> Column:
    return F.lower(F.concat_ws(" ", text_of(F.col("title")), text_of(F.col("abstract"))))


def type_set() -> Column:
    """Lower-cased publication types."""
    return F.filter(F.transform(strings(F.col("publication_types")), lambda t: F.lower(collapse(t))), lambda t: t != "")


def _types(*names: str) -> Column:
    return F.arrays_overlap(type_set(), F.array(*map(F.lit, names)))


def all_streams() -> Column:
    return F.array_distinct(F.concat(F.array("stream"), strings(F.col("secondary_streams"))))


def is_correspondence() -> Column:
    """A letter, reply or notice."""
    return _types(*CORRESPONDENCE_TYPES) | text_of(F.col("title")).rlike(CORRESPONDENCE_TITLE)


def is_protocol() -> Column:
    """A plan of a study."""
    return _types("clinical trial protocol") | text_of(F.col("title")).rlike(PROTOCOL_TITLE)


def is_nonhuman() -> Column:
    """Animals, and no sign of people."""
    return has_any(paper_text(), ANIMALS) & ~has_any(paper_text(), PEOPLE)


def matches_ai_stream() -> Column:
    """Context, direction and, for technical streams, the title fit the stream."""
    title, text = paper_title(), paper_text()
    out = F.lit(False)
    for stream, d in STREAM_DIRECTION.items():
        fits = has_any(text, AI_SIGNALS if d == "H2" else MODEL_SIGNALS) & has_any(text, DIRECTION_TERMS[d])
        if d.startswith("L"):
            fits = fits & (has_any(title, MODEL_SIGNALS) | has_any(title, DIRECTION_TERMS[d]))
        out = F.when(F.col("stream") == stream, fits).otherwise(out)
    return out


def is_relevant(policy: str = "taxonomy") -> Column:
    """Whether a paper belongs to its stream (F18, F19); ``policy`` quality has the mixed chat stream, taxonomy its directions."""
    title, text, s = paper_title(), paper_text(), F.col("stream")
    chat_title = has_any(title, CHAT_TECHNOLOGY) | has_any(title, CHAT_RELATION)
    chat = has_any(text, CHAT_TECHNOLOGY) & has_any(text, CHAT_RELATION) & chat_title
    clinical = has_any(F.lower(text_of(F.col("journal_or_venue"))), CLINICAL_JOURNALS) | has_any(title, CLINICAL_TITLES) | _types(*CLINICAL_TYPES)
    base = (
        F.when(s == "sport_science", has_any(title, SPORT))
        .when(s == "fitness_health", has_any(title, FITNESS))
        .when(s == "sport_nutrition", has_any(title, NUTRITION_ACTIVITY) & has_any(title, NUTRITION))
        .when(s == "clinical_medicine", clinical)
    )
    if policy == "quality":
        return base.when(s == "llm_social", chat).otherwise(False)
    return base.when(s.isin(*STREAM_DIRECTION), matches_ai_stream()).otherwise(False)


def directions() -> Column:
    """Research directions of a paper: its streams', and those whose terms appear in context."""
    text, streams = paper_text(), all_streams()
    model, ai = has_any(text, MODEL_SIGNALS), has_any(text, AI_SIGNALS)
    found = []
    for d in DIRECTIONS:
        own = F.arrays_overlap(streams, F.array(*[F.lit(s) for s, x in STREAM_DIRECTION.items() if x == d]))
        found.append(F.when(own | ((ai if d == "H2" else model) & has_any(text, DIRECTION_TERMS[d])), F.lit(d)))
    return F.array_compact(F.array(*found))


def _stream_directions() -> Column:
    at = F.create_map(*[F.lit(x) for pair in STREAM_DIRECTION.items() for x in pair])
    return F.array_compact(F.transform(all_streams(), lambda s: F.element_at(at, s)))


def primary_direction() -> Column:
    """The first stream's direction, else the first found."""
    return F.coalesce(F.get(_stream_directions(), F.lit(0)), F.get(directions(), F.lit(0)))


def category() -> Column:
    """The one category of a paper; venues have no say."""
    found, streams = directions(), all_streams()
    human = F.arrays_overlap(_stream_directions(), F.array(F.lit("H1"), F.lit("H2")))
    technical = F.exists(found, lambda d: d.startswith("L"))
    return (
        F.when(human, "human_ai")
        .when(technical, "llm_research")
        .when(F.size(found) > 0, "human_ai")
        .when(F.array_contains(streams, "sport_nutrition"), "sport_nutrition_fitness")
        .when(F.array_contains(streams, "sport_science"), "sport_science")
        .when(F.array_contains(streams, "fitness_health"), "sport_nutrition_fitness")
        .when(F.array_contains(streams, "clinical_medicine"), "clinical_medicine")
    )


STUDY = "struct<study_design:string,evidence_tier:string,evidence_score:int>"


def _chain(rules: list[tuple[Column, str, str, int]], last: tuple[str, str, int]) -> Column:
    row = lambda d, t, s: F.struct(F.lit(d).alias("study_design"), F.lit(t).alias("evidence_tier"), F.lit(s).alias("evidence_score"))
    out = row(*last)
    for c, d, t, s in reversed(rules):
        out = F.when(c, row(d, t, s)).otherwise(out)
    return out


def study(animal_title_first: bool = True) -> Column:
    """(design, tier, evidence score) by the stricter rules: titles and types before abstracts, animals apart.

    ``animal_title_first``: a title that names an animal model is preclinical
    whatever else it says (P51).
    """
    title, text = paper_title(), paper_text()
    t = lambda *terms: has_any(title, terms)
    review = t("meta-analysis", "systematic review") | _types("review")
    trial_text = r"\brandomi[sz]ed (?:controlled |clinical |crossover |cross-over )?trial\b|\bparticipants (?:were )?randomly assigned\b|\brandom allocation\b"
    animal_title = has_any(title, ("animal model", "mouse model", "rat model", "murine", "zebrafish", "in mice", "in rats")) & ~has_any(title, PEOPLE)
    rules = [
        (is_correspondence(), "Correspondence", "Letter/U", 12),
        (is_protocol(), "Protocol", "Protocol/U", 25),
        (_types("retracted publication", "expression of concern"), "Retracted/flagged", "Flagged/U", 0),
        (t("scoping review", "mapping review"), "Scoping review", "Scope/B", 55),
        (is_nonhuman() & review, "Preclinical synthesis", "Preclinical/U", 45),
        (is_nonhuman(), "Preclinical study", "Preclinical/U", 40),
        (title.rlike(r"\bquasi[- ]experimental\b|\bnon[- ]randomi[sz]ed\b"), "Quasi-experimental study", "Quasi/B+", 64),
        (title.rlike(r"\bretrospective\b|\bcohort study\b|\bcase[- ]control\b"), "Cohort study", "Cohort/B+", 70),
        (title.rlike(r"\bcross[- ]sectional\b"), "Cross-sectional study", "Cross/B", 50),
        (_types("meta-analysis") | t("meta-analysis", "meta analysis"), "Meta-analysis", "Meta/A", 95),
        (_types("systematic review") | t("systematic review"), "Systematic review", "SR/A", 90),
        (_types("practice guideline", "guideline") | t("clinical guideline"), "Guideline", "Guideline/A", 92),
        (_types("consensus development conference") | t("consensus statement"), "Consensus statement", "Stmt/B+", 78),
        (_types("randomized controlled trial", "controlled clinical trial") | text.rlike(trial_text), "Randomized controlled trial", "RCT/A", 88),
        (has_any(text, ("field experiment",)) | t("field study"), "Field experiment", "Field/A", 82),
        (t("longitudinal") | _types("prospective study"), "Longitudinal study", "Long/A", 78),
        (t("cohort") | _types("cohort"), "Cohort study", "Cohort/B+", 72),
        (t("crossover", "cross-over"), "Crossover study", "Mechanistic/B+", 70),
        (t("qualitative") | has_any(text, ("thematic analysis", "interview study")), "Qualitative study", "Qual/A", 65),
        (t("survey", "questionnaire"), "Survey", "Survey/B", 48),
        (_types("review"), "Narrative review", "Rev/B", 58),
        (F.coalesce(F.col("is_preprint"), F.lit(False)), "Preprint", "Preprint/U", 35),
    ]
    if animal_title_first:
        rules.insert(0, (animal_title, "Preclinical study", "Preclinical/U", 40))
    return _chain(rules, ("Other", "Other/U", 38))


def base_study() -> Column:
    """(design, tier, evidence score) by the first rules: any mention counts, a preprint loses 20 points but keeps 30 (P50)."""
    types, title, text = F.array_join(type_set(), " | "), paper_title(), paper_text()
    in_types = lambda *terms: has_any(types, terms)
    says = lambda *terms: has_any(text, terms)
    rules = [
        (in_types("meta-analysis") | says("meta-analysis", "meta analysis"), "Meta-analysis", "Meta/A", 95),
        (in_types("systematic review") | says("systematic review"), "Systematic review", "SR/A", 90),
        (in_types("guideline") | says("clinical guideline"), "Guideline", "Guideline/A", 92),
        (says("consensus") | in_types("consensus development conference"), "Consensus statement", "Stmt/B+", 78),
        (in_types("randomized controlled trial") | text.rlike(r"\brandomi[sz]ed\b"), "Randomized controlled trial", "RCT/A", 88),
        (says("field experiment", "field study"), "Field experiment", "Field/A", 82),
        (says("longitudinal") | in_types("prospective study"), "Longitudinal study", "Long/A", 78),
        (says("cohort"), "Cohort study", "Cohort/B+", 72),
        (says("crossover", "cross-over"), "Crossover study", "Mechanistic/B+", 70),
        (says("mechanistic") | has_any(title, ("mechanism",)), "Mechanistic study", "Mechanistic/B+", 68),
        (says("qualitative", "thematic analysis", "interview study"), "Qualitative study", "Qual/A", 65),
        (says("cross-sectional", "cross sectional"), "Cross-sectional study", "Cross/B", 52),
        (says("survey", "questionnaire"), "Survey", "Survey/B", 48),
        (in_types("review"), "Narrative review", "Rev/B", 60),
    ]
    preprint = F.coalesce(F.col("is_preprint"), F.lit(False))
    lowered = [(c & preprint, d, f"{t.split('/')[0]}/U", max(s - 20, 30)) for c, d, t, s in rules]
    both = [r for pair in zip(lowered, rules, strict=True) for r in pair]
    return _chain([*both, (preprint, "Preprint", "Preprint/U", 35)], ("Other", "Other/U", 40))


def sample_size() -> Column:
    """The largest number given as a sample size, or null."""
    found = F.regexp_extract_all(paper_text(), F.lit(r"(?:\bn\s*=\s*|sample(?: of| size)?\s+)([0-9][0-9,]{1,8})"), 1)
    return F.array_max(F.transform(found, lambda n: F.replace(n, F.lit(","), F.lit("")).cast("int")))


def exclusion_reason(policy: str = "taxonomy") -> Column:
    """Why a paper can't be selected, or null (F21); needs study_design."""
    return (
        F.when(is_correspondence(), "correspondence/editorial")
        .when(is_protocol(), "protocol/design paper")
        .when(F.col("study_design") == "Retracted/flagged", "retracted or editorially flagged")
        .when(~is_relevant(policy), "title-primary stream relevance gate failed")
    )


def caveat() -> Column:
    """The main limit of a paper's evidence, as a code (P56); needs study_design."""
    d = F.col("study_design")
    by_design = {"Meta-analysis": "STUDY_QUALITY_AND_HETEROGENEITY", "Systematic review": "SEARCH_AND_BIAS", "Randomized controlled trial": "RANDOMISATION_AND_ENDPOINTS", "Cohort study": "RESIDUAL_CONFOUNDING", "Longitudinal study": "ATTRITION_AND_BASELINE", "Cross-sectional study": "NO_TEMPORAL_ORDER", "Survey": "SAMPLING_AND_SELF_REPORT", "Qualitative study": "NOT_GENERALISABLE"}
    out = F.lit("AUTOMATIC_SCREENING_ONLY")
    for k, v in by_design.items():
        out = F.when(d == k, v).otherwise(out)
    chat = (F.col("stream") == "llm_social") & d.isin("Survey", "Cross-sectional study", "Qualitative study")
    return F.when(F.coalesce(F.col("is_preprint"), F.lit(False)), "NOT_PEER_REVIEWED").when(chat, "SELF_SELECTION_AND_PLATFORM").otherwise(out)


def reason() -> Column:
    """Why a paper was selected, as ordered codes without repeats (P63); needs the scores and study_design."""
    return F.array_distinct(F.array_compact(F.array(
        F.col("study_design"),
        F.when(F.coalesce(F.col("open_access"), F.lit(False)), F.lit("OPEN_ACCESS")),
        F.when(F.col("evidence_score") >= 85, F.lit("STRONG_DESIGN")),
        F.when(F.col("interest_score") >= 85, F.lit("NOVEL_SIGNAL")),
        F.when(F.size(directions()) > 0, F.concat(F.lit("DIRECTIONS:"), F.array_join(directions(), ","))),
        F.when(F.col("relevance_score") >= 75, F.concat(F.lit("CORE:"), category())),
    )))
