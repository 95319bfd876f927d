"""Queries over the literal samples give the rows that they gave when these were recorded.

The rows are a run's own output, read through for sense; they guard against changes and are no independent check.
"""

import pytest
from conftest import plain

from curveloom.plans import catalog, registry  # noqa: F401

#: The columns with their types, then a row each.
RECORDED = {
    "figure_specific_text": (
        "id bigint, label string, specific string",
        (1, '1', 'Fig. 1 shows the XRD pattern of the perovskite; peaks at 22.5°, 32.1 degrees and 46 deg are indexed to (1 1 0), (2, 0, 0) and (211).'),
        (2, '2', 'As seen in Fig. 2, the phase is pure.'),
        (2, '3', 'On the other hand, Figure 3 shows an impurity phase at 2θ = 28.4° vs. 28.4 deg.'),
        (3, '4', None),
        (7, '12', 'fig 12b'),
        (7, '5', 'Supplementary Figure S5a.'),
        (9, '3', None),
        (9, '4', None),
        (9, '5', 'figure [3] and Fig(4), etc. are cited; in Fig. 5, the Scherrer equation and FWHM are used; Figure 5 and Fig. 6 differ.'),
        (9, '6', None),
    ),
    "figure_ids": (
        "id int, normal string, valid boolean, figure_id string",
        (1, '1', True, 'fig_1'),
        (2, '7', False, 'fig_8'),
        (3, None, False, 'fig_5'),
        (4, 'x', False, 'f9'),
        (5, None, False, 'figure_c04993b028d9'),
        (6, '2', False, 'fig_2'),
    ),
    "file_stems": (
        "stem string, pattern int, output string, band string",
        ('Figure_007', 7, 'figure_7', 'Figure_007_curve_2'),
        ('curve', None, 'curve_digitized', 'curve_curve_2'),
        ('fig-3b', None, 'figure_3', 'fig-3b_curve_2'),
        ('pattern_12', 12, 'pattern_12_digitized', 'pattern_12_curve_2'),
        ('sample_figure9', None, 'figure_9', 'sample_figure9_curve_2'),
    ),
    "tei_metadata": (
        "doc_id string, title string, doi string, abstract string, journal string, publication_date string, keywords string, authors string",
        ('a', 'A perovskite', '10.1000/tei.1', 'Short abstract.', 'J. Test', '2021-03-01', 'xrd,oxide', '[{"given":"Ada","middle":"M.","surname":"Low","email":"a@x.org","affiliation":"Uni A","orcid":"0000-1"}]'),
    ),
    "tei_sections": (
        "doc_id string, ordinal int, parent int, section_id string, path string, section_type string",
        ('a', 0, None, 'section_body_unclassified', 'Unclassified body text', 'other'),
        ('a', 1, None, 's1', 'Results', 'results'),
        ('a', 2, 1, 'section_c99b39766adf', 'Results/Details', 'results'),
        ('a', 3, None, 'section_c0fd9c3910f4', 'Untitled section 2', 'other'),
    ),
    "tei_paragraphs": (
        "doc_id string, ordinal int, paragraph_id string, section_type string, refs string, score double, peaks string, miller string",
        ('a', 0, 'paragraph_9e68e8feeded', 'results', '1,2', 9.4, '[32.1]', '[]'),
        ('a', 1, 'paragraph_92e85048eb1c', 'results', '', 1.3, '[]', '["(1 1 0)"]'),
        ('a', 2, 'paragraph_4ae4b6a0116e', 'results', '1,7', 4.2, '[46.0]', '[]'),
        ('a', 3, 'paragraph_e13ae40d46a9', 'other', '', 0.0, '[]', '[]'),
        ('a', 4, 'paragraph_61ea22250cd0', 'other', '', 4.0, '[]', '[]'),
    ),
    "tei_tables_and_references": (
        "doc_id string, kind string, id string, title string, text string",
        ('a', 'reference', 'b0', 'Old work', '1999|B High'),
        ('a', 'table', 'tab_0', 'Cell data.', 'a 3.9'),
    ),
    "tei_figures_linked": (
        "doc_id string, ordinal int, figure_id string, new_id string, normalized_label string, score double, likely boolean, n_refs int, n_context int",
        ('a', 0, 'fig_0', 'fig_1', '1', 11.0, True, 2, 5),
        ('a', 1, 'fig_1', 'fig_2', '2', 1.5, True, 1, 5),
    ),
    "tei_records": (
        "doc_id string, figure_id string, combined_analysis_text string, peaks string, miller string, n int",
        ('a', 'fig_0', 'Fig. 1 shows the XRD pattern with a peak at 32.1°.\n\nThe lattice is indexed to (1 1 0).\n\nFigure 1 has Bragg reflections at 46 degrees; see Fig. 7.', '[32.1,46.0]', '[]', 2),
        ('a', 'fig_1', 'Fig. 2 is an image.\n\nThe lattice is indexed to (1 1 0).', '[32.1]', '[]', 1),
    ),
    "tei_figure_dataset": (
        "doc_id string, figure int, figure_path string, caption string, text string",
        ('a', 1, '', 'XRD patterns of the film.', 'XRD patterns of the film. Fig. 1 shows the XRD pattern with a peak at 32.1°. The lattice is indexed to (1 1 0). Figure 1 has Bragg reflections at 46 degrees; see Fig. 7.'),
        ('a', 2, '', 'A photograph.', 'A photograph. Fig. 2 is an image. The lattice is indexed to (1 1 0).'),
        ('a', 7, '', '', 'Figure 1 has Bragg reflections at 46 degrees; see Fig. 7.'),
    ),
    "tei_counts": (
        "doc_id string, n_sections bigint, n_paragraphs bigint, n_figures bigint, n_tables bigint, n_bibliography bigint, n_likely bigint, n_likely_with_image bigint",
        ('a', 4, 5, 2, 1, 1, 2, 1),
    ),
    "discovered_works": (
        "id string, material_score int, xrd_score int, relevance_score int",
        ('https://openalex.org/W1', 37, 53, 90),
        ('https://openalex.org/W4', 29, 12, 41),
    ),
    "work_facts": (
        "id string, title string, body string, authors string, journal string",
        ('https://openalex.org/W1', 'Halide perovskite XRD pattern by Rietveld refinement', 'x-ray diffraction of perovskite XRD ', 'Ada Low;B. High', 'J. A'),
        ('https://openalex.org/W2', 'Double perovskite powder x-ray diffraction', 'xrd  ', '', None),
        ('https://openalex.org/W3', 'Perovskite oxide crystal structure', '  ', '', None),
        ('https://openalex.org/W4', 'Layered perovskite: neutron diffraction', '  ', '', None),
        ('https://openalex.org/W5', 'Cats', '  ', '', None),
        ('https://openalex.org/W6', 'Perovskite XRD', '  ', '', None),
    ),
    "pdf_candidates": (
        "id string, rank int, url string, provider string, license string, version string",
        ('https://openalex.org/W1', 0, 'https://a.org/1.pdf', 'openalex:primary_location', 'cc-by', None),
        ('https://openalex.org/W1', 1, 'https://b.org/x.PDF?d=1', 'openalex:location', None, 'publishedVersion'),
        ('https://openalex.org/W1', 2, 'https://content.example.org/works/W1.pdf', 'openalex:cached_content', None, None),
        ('https://openalex.org/W4', 0, 'http://d.org/z.pdf', 'openalex:best_oa_location', None, 'v1'),
    ),
    "widened_crops": (
        "page int, crop string, x0 double, y0 double, x1 double, y1 double, caption_y0 double",
        (1, 'a', 35.0, 85.0, 200.0, 215.0, 260.0),
    ),
    "tick_chain": (
        "axis string, k int, px int, value double",
        ('counts', 0, 10, 500.0),
        ('gap', 0, 100, 10.0),
        ('gap', 1, 200, 20.0),
        ('gap', 2, 300, 30.0),
        ('gap', 3, 400, 40.0),
        ('gap', 4, 500, 50.0),
        ('gap', 5, 600, 60.0),
        ('ghost', 0, 114, 5.0),
        ('ghost', 1, 630, 10.0),
        ('ghost', 2, 1146, 15.0),
        ('ghost', 3, 1662, 20.0),
        ('ghost', 4, 2178, 25.0),
        ('ghost', 5, 2694, 30.0),
        ('unit', 0, 10, 0.0),
    ),
    "tick_filter_y": (
        "axis string, k int, px int, value double",
        ('counts', 0, 10, 500.0),
        ('counts', 1, 60, 400.0),
        ('counts', 2, 110, 300.0),
        ('gap', 0, 400, 40.0),
        ('gap', 1, 500, 50.0),
        ('ghost', 0, 114, 5.0),
        ('ghost', 1, 630, 10.0),
        ('ghost', 2, 1146, 15.0),
        ('ghost', 3, 1662, 20.0),
        ('ghost', 4, 2178, 25.0),
        ('ghost', 5, 2694, 30.0),
        ('unit', 0, 10, 1.0),
        ('unit', 1, 20, 0.8),
        ('unit', 2, 30, 0.6),
        ('unit', 3, 40, 0.4),
        ('unit', 4, 50, 0.2),
        ('unit', 5, 60, 0.0),
    ),
}


@pytest.mark.parametrize("name", sorted(RECORDED))
def test_recorded(name, spark, small):
    columns, *rows = RECORDED[name]
    got = registry.QUERIES[name](spark, small)
    assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == columns
    assert sorted((tuple(map(plain, r)) for r in got.collect()), key=repr) == sorted((tuple(map(plain, r)) for r in rows), key=repr)
