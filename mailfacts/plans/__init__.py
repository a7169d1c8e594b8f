"""The eleven jobs, as functions from source tables and run parameters to a result.

Times given as text are MST; ``build_ts`` is the MST build time stored with the rows, a
parameter so that a run can be repeated.
"""

from mailfacts.plans.clean import clean_opens, clean_sends, queue_stage
from mailfacts.plans.dimensions import dim_campaign, dim_holdout, dim_template
from mailfacts.plans.flags import flag_first_response
from mailfacts.plans.responses import response_fact_ocp, response_fact_sfmc
from mailfacts.plans.sends import send_fact_ocp, send_fact_sfmc

__all__ = [
    "clean_opens",
    "clean_sends",
    "dim_campaign",
    "dim_holdout",
    "dim_template",
    "flag_first_response",
    "queue_stage",
    "response_fact_ocp",
    "response_fact_sfmc",
    "send_fact_ocp",
    "send_fact_sfmc",
]
