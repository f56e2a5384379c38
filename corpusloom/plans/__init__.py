"""The registered queries."""

from corpusloom.plans import cleaning, marks, web  # noqa: F401  (each fills the registry)
