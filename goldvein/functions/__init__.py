"""Column functions: pure ``Column -> Column`` builders on built-in Spark SQL
functions, so they stay inside whole-stage codegen."""

from goldvein.functions.text import (  # noqa: F401
    initcap_words, clean_email, is_valid_email, mvr_email, format_phone,
    identity_string,
)
from goldvein.functions.keys import contact_key, surrogate_key  # noqa: F401
from goldvein.functions.scoring import (  # noqa: F401
    dq_score, rfm_segment, sentiment_label, match_tier,
)
from goldvein.functions.masks import mask_email, mask_phone, mask_ssn  # noqa: F401
from goldvein.functions.dates import hours_between, days_between  # noqa: F401
from goldvein.functions.vectors import dot, norm, cosine  # noqa: F401
