"""``python -m pistil data|model ...``: the command line of ``pistil.plans.cli``."""

from pistil.plans.cli import main

main()
