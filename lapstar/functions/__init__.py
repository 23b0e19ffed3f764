from lapstar.functions.columns import *  # noqa: F403
