"""The words that name a listing's kind and qualities."""

COMMERCIAL = r"comercial|galp[aã]o|pr[eé]dio|loja|escrit[oó]rio|barrac[aã]o|industrial"

QUALITY_FLAGS = {
    "tem_piscina": r"piscina",
    "eh_alto_padrao": r"alto padr[aã]o|luxo|requintad|exclusiv",
    "tem_mobilia": r"mobiliad|armári|armari|planejad",
}

TYPE_FLAGS = {
    "eh_terreno": r"lote|terreno|[aá]rea |fazenda|ch[aá]cara|s[ií]tio|rural",
    "eh_apartamento": r"apartamento|apto|studio|kitnet|flat",
    "eh_casa": r"casa|sobrado|mans[aã]o",
}

ALL_FLAGS = {"eh_comercial": COMMERCIAL, **QUALITY_FLAGS, **TYPE_FLAGS}
