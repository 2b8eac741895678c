"""Texts of the site's status messages."""

# Message key -> text, as the pages show them.
MESSAGES = {
    "STATUS_FIELD_LABEL_LONG": "Status",
    "STATUS_FIELD_LABEL_SHORT": "STATUS",
    "STATUS_FIELD_LABEL_COL": "Status",
    "STATUS_FILTER": "Status",
    "STATUS_FILTER_ACT": "Active",
    "STATUS_FILTER_PEND": "Pending",
    "STATUS_FILTER_DEL": "Deleted",
    "STATUS_FILTER_INA": "Inactive",
    "STATUS_ACT": "Active",
    "STATUS_ROM_ACT": "Active",
    "STATUS_PEND": "Pending",
    "STATUS_PEND_W": "Pending: Irregularity Letter",
    "STATUS_PEND_A": "Pending: Abandoned",
    "STATUS_PEND_T": "Pending: Translation",
    "STATUS_PEND_E": "Pending: formalities examination",
    "STATUS_PEND_R": "Pending: Pre-examination",
    "STATUS_PEND_APP_W": "Pending application: irregularity letter",
    "STATUS_PEND_APP_A": "Pending application: abandoned",
    "STATUS_PEND_APP_T": "Pending Application: translation",
    "STATUS_PEND_APP_E": "Pending application:  formalities examination",
    "STATUS_PEND_APP_R": "Pending Application: pre-examination",
    "STATUS_PEND_SD_W": "Pending subsequent designation: irregularity letter",
    "STATUS_PEND_SD_A": "Pending subsequent designation: abandoned",
    "STATUS_PEND_SD_T": "Pending subsequent designation: translation",
    "STATUS_PEND_SD_E": "Pending subsequent designation: formalities examination",
    "STATUS_PEND_SD_R": "Pending subsequent designation: pre-examination",
    "STATUS_DEL": "Deleted",
    "STATUS_INA": "Inactive",
    "STATUS_ROM_INA": "Inactive",
    "STATUS_ROM_INA_EXP": "Inactive: expired",
    "STATUS_ROM_INA_RAN": "Inactive: cancelled by holder",
    "STATUS_ROM_INA_REN2": "Inactive: expired",
    "STATUS_ROM_INA_CBNT": "Inactive: cancelled by Office of origin",
    "STATUS_ROM_INA_NUL": "Inactive - null and void",
    "STATUS_INA_EXP": "Inactive (expired)",
    "STATUS_INA_RAN": "Inactive (cancelled by holder)",
    "STATUS_INA_REN2": "Inactive (expired)",
    "STATUS_INA_CBNT": "Inactive (cancelled by office of origin)",
    "STATUS_INA_NUL": "Inactive",
    "STATUS_INA_GRACE": "Inactive (within grace period)",
    "STATUS_ACT_GRACE": "Active (within grace period)",
    "STATUS_ROM_ACT_GRACE": "Active(within grace period)",
    "NO_VERBAL_ELEMENTS": "No Verbal Elements",
    "STATUS_FILTER_TIP": "The current status of the record.",
    "STATUS_STATUS_FILTER_INA_FACET_TIP": "No longer in force",
    "STATUS_STATUS_FILTER_ACT_FACET_TIP": "Currently in force",
    "STATUS_STATUS_FILTER_PEND_FACET_TIP": "Not yet in force",
    "STATUS_FILTER_REG": "Registered",
    "STATUS_FILTER_APP": "Appealed",
    "STATUS_FILTER_EXA": "Examined",
    "STATUS_FILTER_FIL": "Filed",
    "STATUS_FILTER_OPP": "Opposed",
    "STATUS_FILTER_ABA": "Abandoned",
    "STATUS_FILTER_AWA": "Awaiting Court Action",
    "STATUS_FILTER_EXP": "Expired",
    "STATUS_FILTER_INV": "Invalidated",
    "STATUS_FILTER_REJ": "Rejected",
    "STATUS_FILTER_WIT": "Withdrawn",
    "STATUS_FILTER_PUB": "Published",
    "STATUS_FILTER_SUR": "Surrendered",
    "STATUS_REG": "Registered",
    "STATUS_APP": "Appealed",
    "STATUS_EXA": "Examined",
    "STATUS_FIL": "Filed",
    "STATUS_OPP": "Opposed",
    "STATUS_ABA": "Abandoned",
    "STATUS_EXP": "Expired",
    "STATUS_INV": "Invalidated",
    "STATUS_REJ": "Rejected",
    "STATUS_WIT": "Withdrawn",
    "STATUS_PUB": "Published",
    "STATUS_SUR": "Surrendered",
    "STATUS_PEND_TRAN": "Pending Subsequent Designation",
    "STATUS_PEND_APP": "Pending Application",
    "STATUS_PEND_SD": "Pending Subsequent Designation",
    "STATUS_PEND_W_TEXT": "Irregularity Letter",
    "STATUS_PEND_A_TEXT": "Abandoned",
    "STATUS_PEND_T_TEXT": "Translation",
    "STATUS_PEND_E_TEXT": "Formalities Examination",
    "STATUS_PEND_R_TEXT": "Pre-examination",
    "STATUS_FLOW_W": "",
    "STATUS_FLOW_A": "",
    "STATUS_FLOW_T": "",
    "STATUS_FLOW_E": "",
    "STATUS_FLOW_R": "",
    "STATUS_W": "Irregular ",
    "STATUS_A": "Abandoned ",
    "STATUS_T": "Being translated ",
    "STATUS_E": "Under Examination ",
    "STATUS_R": "Awaiting examination ",
    "STATUS_Z": "Cancelled ",
    "STATUS_REGISTERED": "Registered ",
    "STATUS_RECORDED": "Recorded",
    "STATUS_PAID": "Paid ",
    "STATUS_NULL_AND_VOID": "Following $1, null and void",
    "STATUS_W_TOOLTIP": "There is an irregularity in the application, request or communication that must be remedied ",
    "STATUS_A_TOOLTIP": "An irregularity was not remedied and the application, request or communication was deemed abandoned ",
    "STATUS_T_TOOLTIP": "The application, request or communication has been examined and is now being translated ",
    "STATUS_E_TOOLTIP": "The application, request or communication has been assigned to an examiner",
    "STATUS_R_TOOLTIP": "The application, request or communication has been received and has not yet been assigned to an examiner.",
    "STATUS_Z_TOOLTIP": "Application, request or communication has been dismissed, possibly due to being a duplicate of another request, or other procedural issue. ",
    "STATUS_REGISTERED_TOOLTIP": "The application has resulted in a registration in the International Register. ",
    "STATUS_RECORDED_TOOLTIP": "The application, request or communication has resulted in a recording in the International Register.",
    "STATUS_PAID_TOOLTIP": "Second part fee has been paid for this designation.",
    "STATUS_NULL_AND_VOID_TOOLTIP": "Null and void",
    "STATUS_TOOLTIP": "Due to the transaction history, the exact list of goods and services that remain in force for this designation is difficult to automatically calculate.",
    "STATUS_STATUS": "Complex",
    "STATUS_STATUS_TOOLTIP": "Due to the transaction history, the exact list of goods and services that remain in force for this designation is difficult to automatically calculate.",
    "STATUS_HEADER": "Complex  ",
    "STATUS_ERROR_HEADER": "The exact status for this designation is difficult to calculate automatically for the following reasons:   ",
    "STATUS_OF_PROTECTION": "Current Status of Protection",
    "STATUS_IR_RECEIVED": "Received",
    "STATUS_CORRECTED": "Following correction $1, replaced by $2.",
    "STATUS_PRIOR_TO_NONRENEWAL_LINK": "View status disregarding the non-renewal of $1",
}
