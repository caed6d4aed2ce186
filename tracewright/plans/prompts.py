"""Request templates. Placeholders in braces are filled per row; pass your own to change wording."""

DIFFICULTY_HINTS = {
    "L0": "nothing to do but ask back: the request is vague or points at something missing",
    "L1": "one tool call on an object named by its id",
    "L2": "the object is whatever is selected and has to be read from the state",
    "L3": "a chain of two or three tool calls",
    "L4": "builds on artifacts drawn earlier in the conversation",
    "L5": "adversarial: ambiguous, wrong type, visual or dangerous",
}

BLUEPRINT = """Write one task blueprint for a map assistant that sees structured state only, never the map itself.

Scenario: {scenario}
Tools: {tools}
Task family: {family}
Difficulty: {difficulty} - {hint}

Answer with one JSON object with the keys task_type, difficulty, target (reference_mode, expected_type,
object_id), constraints, required_semantic_steps, expected_final_state, should_ask_clarification,
negative_case and initial_state. Use ids of the scenario only."""

UTTERANCES = """Put this task into words a user might say, without adding or dropping anything.

Task: {blueprint}

Give six variants: formal Vietnamese, casual Vietnamese, formal English, mixed Vietnamese and English,
a command of at most eight words, and a chatty one. If the target is the selected object, say "this" and
leave its id out. Answer with {"utterances": [...]} only."""

VERIFIER = """Judge whether this sample is consistent: request, target, steps, assertions, ids and, for
negative cases, asking back instead of acting.

Sample: {sample}

Answer with {"valid": true or false, "issues": [...], "suggested_fix": null or text} only."""

ADVERSARIAL = """Write one blueprint a map assistant must not act on: a visual reference, an unsupported or dangerous
action, or a tool used on the wrong kind of object.

Scenario: {scenario_id}
Some object ids: {object_ids}

Answer with one JSON blueprint that has negative_case and should_ask_clarification set."""

PLAN = """Write the tool calls that carry out this blueprint as a JSON array of {"tool": ..., "args": {...}}. Refer
to an earlier result as $tool.field. The ids of the scenario follow, in numbered pages.

Scenario: {scenario_id}
Blueprint: {blueprint}"""
