"""Word lists, weights and patterns that decide scores. They are data, not logic, and must not be edited."""

from __future__ import annotations

# Weight of each material term in a title.
MATERIAL_TITLE = {
    "metal halide perovskite": 18, "lead halide perovskite": 18, "ordered double perovskite": 18, "vacancy-ordered perovskite": 18,
    "perovskite oxide": 17, "oxide perovskite": 17, "halide perovskite": 17, "hybrid perovskite": 17, "double perovskite": 17,
    "layered perovskite": 16, "lead-free perovskite": 16, "all-inorganic perovskite": 16, "perovskite-type": 15, "perovskite type": 15,
    "perovskite-related": 14, "perovskite-derived": 14, "perovskite": 13, "ruddlesden-popper": 14, "ruddlesden popper": 14,
    "dion-jacobson": 14, "dion jacobson": 14, "brownmillerite": 11, "aurivillius": 11, "antiperovskite": 10,
}

# Weight of each diffraction term in a title.
XRD_TITLE = {
    "powder x-ray diffraction": 18, "powder x ray diffraction": 18, "x-ray diffraction": 15, "x ray diffraction": 15, "xrd pattern": 15,
    "xrd patterns": 15, "rietveld refinement": 16, "rietveld analysis": 15, "diffraction pattern": 12, "powder diffraction": 12,
    "synchrotron x-ray diffraction": 15, "neutron diffraction": 12, "phase identification": 10, "phase analysis": 9, "phase purity": 9,
    "structural refinement": 10, "crystal structure": 8, "lattice parameter": 8, "lattice parameters": 8, "space group": 8,
    "peak indexing": 9, "crystallite size": 7,
}

# Weight of each material term in a body.
MATERIAL_BODY = {
    "metal halide perovskite": 11, "lead halide perovskite": 11, "perovskite oxide": 10, "oxide perovskite": 10, "halide perovskite": 10,
    "double perovskite": 10, "layered perovskite": 9, "hybrid perovskite": 9, "perovskite-type": 9, "perovskite type": 9, "perovskite": 7,
}

# Weight of each diffraction term in a body.
XRD_BODY = {
    "powder x-ray diffraction": 12, "powder x ray diffraction": 12, "x-ray diffraction": 9, "x ray diffraction": 9, "xrd": 5, "pxrd": 8,
    "gixrd": 8, "grazing incidence x-ray diffraction": 10, "synchrotron x-ray diffraction": 10, "neutron diffraction": 8,
    "rietveld refinement": 12, "rietveld analysis": 11, "rietveld method": 11, "fullprof": 8, "gsas": 8, "topas": 8, "maud": 7,
    "structural refinement": 9, "profile refinement": 8, "le bail refinement": 9, "pawley refinement": 9,
    "diffraction pattern": 8, "xrd pattern": 9, "diffraction peak": 7, "diffraction peaks": 7, "characteristic peak": 6,
    "characteristic peaks": 6, "bragg peak": 7, "bragg peaks": 7, "peak position": 6, "peak positions": 6, "peak shift": 7,
    "peak splitting": 8, "peak broadening": 7, "peak intensity": 5, "preferred orientation": 7, "texture coefficient": 6,
    "miller indices": 7, "indexed to": 5, "phase identification": 8, "phase purity": 8, "secondary phase": 7, "secondary phases": 7,
    "impurity phase": 7, "single phase": 6, "crystalline phase": 5, "crystal structure": 6, "space group": 7, "lattice parameter": 7,
    "lattice parameters": 7, "unit cell": 6, "cell volume": 6, "crystallite size": 6, "scherrer equation": 7, "williamson-hall": 7,
    "microstrain": 6, "cubic phase": 5, "tetragonal phase": 5, "orthorhombic phase": 5, "rhombohedral phase": 5, "monoclinic phase": 4,
    "octahedral tilting": 7, "octahedral distortion": 7, "b-site ordering": 7, "superlattice reflection": 8, "superlattice peak": 8,
    "cu kα": 5, "cu k-alpha": 5, "2θ": 6, "2 theta": 6, "diffractometer": 5, "room temperature xrd": 5,
}

# Weight of each strong term in a paragraph, and the terms that weigh 0.4.
PARAGRAPH_STRONG = {
    "xrd": 4.0, "x-ray diffraction": 4.0, "x ray diffraction": 4.0, "powder diffraction": 4.0, "diffractogram": 4.0, "rietveld": 4.0,
    "2 theta": 3.0, "2θ": 3.0, "bragg": 2.0, "diffraction pattern": 3.0, "xrd pattern": 4.0, "pxrd": 4.0,
}
PARAGRAPH_ANALYSIS = (
    "peak", "peaks", "reflection", "reflections", "plane", "planes", "phase", "phases", "crystalline", "crystallinity", "amorphous",
    "lattice", "cell parameter", "lattice parameter", "space group", "indexed", "indexing", "shift", "broadening", "intensity",
    "crystallite size", "scherrer", "rietveld", "bragg", "impurity", "secondary phase", "preferred orientation",
    "full width at half maximum", "fwhm",
)

# Phrases that name a section's kind; the first kind that fits wins.
SECTION_KINDS = (
    ("results", (
        "result", "results", "discussion", "results and discussion", "characterization", "structural characterization", "crystal structure",
        "phase analysis", "x-ray diffraction", "xrd analysis", "structural analysis", "phase identification", "rietveld refinement",
        "experimental results",
    )),
    ("methods", (
        "experimental", "materials and methods", "methods", "characterization", "xrd measurement", "x-ray diffraction measurement",
        "instrumentation",
    )),
    ("introduction", ("introduction", "background")),
    ("conclusion", ("conclusion", "summary")),
    ("abstract", ("abstract",)),
    ("references", ("reference", "bibliography")),
)

# Patterns.
DOI = r"(?i)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+\b"
THETA = r"(?i)2\s*(?:theta|θ)"
DEGREES = r"(?i)(\d{1,3}(?:\.\d+)?)\s*(?:°|degrees?|deg)"
MILLER = r"\(\s*[\-−]?\d+\s*[,\s]*[\-−]?\d+\s*[,\s]*[\-−]?\d+\s*\)"
FIGURE_REFERENCE = r"(?i)\b(?:supplementary\s+)?fig(?:ure)?s?\.?\s*[(\[\s]*([A-Za-z]?\d+[A-Za-z]?)"
CAPTION_LABEL = r"(?i)\bfig(?:ure)?s?\.?\s*([A-Za-z]?\d+[A-Za-z]?)"
ABBREVIATION = r"(?i)\b(Fig(?:ure)?|vs|etc)\."
CLAUSE = r"(?i);\s*|(?:\.\s+)?On the other hand,\s*"

# Thresholds of figure linking, relevance and acquisition.
CONTEXT_WINDOW, SECTION_SCORE, WINDOW_SCORE, CAPTION_SCORE, PARAGRAPH_CONTEXT, CONTEXT_SUM = 4, 1.0, 1.5, 2.5, 2.0, 4.0
MIN_MATERIAL, MIN_XRD = 7, 7
