"""Names, labels, tables and limits that results must agree with.

Raw field names and dimension values are given by the upstream record format; labels, error
numbers and limits are given by the existing reports and runbooks.
"""

# --- activity counters, in record order
COUNTS = (
    "user_initiated_interaction_count",
    "code_generation_activity_count",
    "code_acceptance_activity_count",
    "loc_suggested_to_add_sum",
    "loc_suggested_to_delete_sum",
    "loc_added_sum",
    "loc_deleted_sum",
)

# --- three-valued usage flags: staged column -> raw field
FLAGS = {
    "used_agent": "used_agent",
    "used_chat": "used_chat",
    "used_cli": "used_cli",
    "used_copilot_app": "used_copilot_app",
    "used_copilot_cloud_agent": "used_copilot_cloud_agent",
    "used_code_review_active": "used_copilot_code_review_active",
    "used_code_review_passive": "used_copilot_code_review_passive",
}

# --- editor families by raw `ide` value; anything else is OTHER_FAMILY
IDE_FAMILIES = {
    "vscode": "VS Code",
    "visualstudio": "Visual Studio",
    "intellij": "JetBrains",
    "eclipse": "Eclipse",
    "xcode": "Xcode",
    "neovim": "Neovim",
    "vim": "Vim",
    "emacs": "Emacs",
    "zed": "Zed",
}
OTHER_FAMILY = "Other"

# --- feature groups: exact value first, then prefix, then OTHER_GROUP
FEATURE_GROUPS = {
    "code_completion": "Completions",
    "agent_edit": "Agent",
    "copilot_cli": "CLI",
    "copilot_app": "App",
}
FEATURE_GROUP_PREFIXES = {"chat": "Chat"}
OTHER_GROUP = "Other"

# --- defaults for missing text
NO_PHASE = "No Cohort"
UNKNOWN = "unknown"
OTHERS = "others"
UNASSIGNED = "unassigned"
UNATTRIBUTED = "unattributed"
UNATTRIBUTED_LABEL = "Unattributed"

# --- allocation labels
BY_INTERACTIONS = "user_interactions"
BY_GENERATIONS = "code_generations"
EQUAL_SPLIT = "equal_split"
EXACT_UNALLOCATED = "exact-unallocated"
FEATURE_ONLY = "feature-only"
MODELLED = "modelled"

# --- reconciliation errors
ORPHANED_BILLING = 51001
NOTHING_STAGED = 51002
NO_SEATS = 51005

# --- run states
RUNNING, SUCCEEDED, FAILED, ABANDONED = "running", "succeeded", "failed", "abandoned"
STALE_AFTER_MINUTES = 120

# --- limits and windows
RELOAD_TRAILING_DAYS = 7
BACKFILL_DAYS = 28
DEFAULT_LIMIT = 25
DEFAULT_WINDOW_DAYS = 30
IDLE_DAYS = 30
STALLED_HOURS = 48
RETAIN_DAYS = 730
ROLLING_DAYS = 30
DAYS_IN_MONTH = 30.4
REPORT_ROWS = 12
TEAM_REPORT_ROWS = 15
TOP_REPORT_ROWS = 10

# --- raw zone
DATASETS = {
    "user_activity": "users_1_day",
    "user_teams": "user_teams_1_day",
    "premium_requests": "premium_requests",
    "seats": "seats",
}
UNSAFE_SEGMENT = "[^A-Za-z0-9._-]"
UNNAMED = "unnamed"

# --- fields that each raw record type must carry
EXPECTED_FIELDS = {
    "user_metrics": (
        "day", "user_id", "user_login", "ai_credits_used",
        "user_initiated_interaction_count", "code_generation_activity_count",
        "code_acceptance_activity_count", "loc_added_sum",
        "totals_by_ide", "totals_by_model_feature", "ai_adoption_phase",
    ),
    "totals_by_ide[]": (
        "ide", "user_initiated_interaction_count", "code_generation_activity_count",
    ),
    "totals_by_model_feature[]": ("model", "feature", "user_initiated_interaction_count"),
    "user_teams": ("user_id", "user_login", "day", "team_id", "slug"),
    "premium_request_usage": ("usageItems",),
    "usageItems[]": ("product", "sku", "model", "netAmount", "grossAmount", "netQuantity"),
    "seats": ("assignee",),
}
