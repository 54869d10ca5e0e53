"""veilspark: sensitive-data governance on PySpark.

Common entry points:

    from veilspark import SecurityContext, governed_frame, apply_masks, apply_row_policy
    from veilspark import tokenize_ssn, detokenize_ssn
    from veilspark.operators import detect, audit, grants, deident
    from veilspark.plans import reports, checks
"""

from .context import SecurityContext
from .functions.masks import get_mask, mask_names, register_mask
from .functions.tokens import detokenize_ssn, tokenize_ssn
from .operators.masking import CLAIMS_BINDINGS, PATIENT_BINDINGS, apply_masks
from .operators.rowaccess import apply_row_policy
from .plans.governed import governed_frame, governed_from_registry, governed_view

__version__ = "0.1.0"

__all__ = [
    "SecurityContext", "apply_masks", "apply_row_policy", "governed_frame",
    "governed_from_registry", "governed_view", "tokenize_ssn", "detokenize_ssn", "register_mask", "get_mask",
    "mask_names", "PATIENT_BINDINGS", "CLAIMS_BINDINGS",
]
