"""The built-in gene panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Tissue -> panel -> genes, in order.
GENE_PANELS = {
    "breast_cancer": {
        "epithelial": ["KRT19", "KRT8", "KRT18", "EPCAM", "CDH1", "CLDN3", "CLDN4"],
        "stromal": ["COL1A1", "COL1A2", "VIM", "ACTA2", "PDGFRA", "FAP", "THY1"],
        "immune": ["CD68", "CD3E", "CD8A", "CD4", "FOXP3", "PTPRC", "CD19", "CD20"],
        "endothelial": ["PECAM1", "VWF", "CD34", "CLDN5", "FLT1"],
        "cancer_markers": ["ESR1", "PGR", "ERBB2", "MKI67", "TP53", "CCND1"],
        "housekeeping": ["ACTB", "GAPDH", "B2M", "PPIA", "HPRT1"],
        "mitochondrial": ["MT-CO1", "MT-ND1", "MT-ATP6", "MT-CYB", "MT-ND2"],
    },
    "brain": {
        "neurons": ["RBFOX3", "SYP", "MAP2", "TUBB3", "ENO2"],
        "astrocytes": ["GFAP", "S100B", "AQP4", "ALDH1L1"],
        "oligodendrocytes": ["MBP", "PLP1", "MOG", "OLIG2"],
        "microglia": ["IBA1", "CX3CR1", "TMEM119", "P2RY12"],
        "endothelial": ["PECAM1", "VWF", "CD34", "CLDN5"],
    },
    "immune": {
        "t_cells": ["CD3E", "CD3D", "CD8A", "CD4", "IL7R"],
        "b_cells": ["CD19", "CD20", "MS4A1", "CD79A"],
        "macrophages": ["CD68", "CD163", "CSF1R", "MARCO"],
        "dendritic": ["CD1C", "CLEC9A", "FCER1A", "CD141"],
        "nk_cells": ["KLRD1", "KLRF1", "NCR1", "GNLY"],
    },
}


def panel_table(spark: SparkSession, panels: dict[str, dict[str, list[str]]] | None = None) -> DataFrame:
    """(tissue, panel, ord, gene) rows of the built-in or the given panels."""
    rows = [
        (tissue, panel, at, gene)
        for tissue, group in (panels or GENE_PANELS).items()
        for panel, genes in group.items()
        for at, gene in enumerate(genes)
    ]
    return spark.createDataFrame(rows, "tissue string, panel string, ord long, gene string")
