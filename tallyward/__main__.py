"""``python -m tallyward <land|bronze|refresh> ...`` — the job entry points."""

from tallyward.plans.jobs import cli

if __name__ == "__main__":
    cli()
