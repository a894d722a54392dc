"""Fixed values of the domain: official codes, labels, field names and expected counts. They have to be just these for
results to agree with the published tables, spelling included."""

# Subclasses of the technology sector (7-digit economic activity codes).
TECH_SUBCLASSES = ("6201500", "6201501", "6201502", "6202300", "6203100", "6204000", "6209100", "6311900", "6319400", "6399200")

# Occupation families of technology (first 4 digits of the occupation code), and single occupations.
TECH_FAMILIES = ("1236", "1425", "2031", "2122", "2123", "2124", "3171", "3172")
TECH_OCCUPATIONS = ("313220", "313305", "142135")

# Areas of technology work.
AREA_FAMILIES = {
    "Desenvolvimento": ("2124", "3171"),
    "Suporte e Operação": ("3172",),
    "Infraestrutura e Dados": ("2123",),
    "Engenharia e Pesquisa": ("2122", "2031"),
    "Gestão e Direção": ("1425", "1236"),
}
AREA_OCCUPATIONS = {"313220": "Suporte e Operação", "313305": "Infraestrutura e Dados", "142135": "Gestão e Direção"}
AREA_OTHER = "Outra ocupação (empresa de TI)"

# Labels of the two lenses.
LENS_BOTH = "Profissional de TI em empresa de TI"
LENS_OCCUPATION = "Profissional de TI fora do setor de TI"
LENS_OTHER = "Outra ocupação em empresa de TI"

# Sections of economic activity as (first division, last division, name), as the ministry spells them.
SECTIONS = (
    (1, 3, "Agricultura, Pecuária, Produção Florestal, Pesca e AqÜIcultura"),
    (5, 9, "Indústrias Extrativas"),
    (10, 33, "Indústrias de Transformação"),
    (35, 35, "Eletricidade e Gás"),
    (36, 39, "Água, Esgoto, Atividades de Gestão de Resíduos e Descontaminação"),
    (41, 43, "Construção"),
    (45, 47, "Comércio, Reparação de Veículos Automotores e Motocicletas"),
    (49, 53, "Transporte, Armazenagem e Correio"),
    (55, 56, "Alojamento e Alimentação"),
    (58, 63, "Informação e Comunicação"),
    (64, 66, "Atividades Financeiras, de Seguros e Serviços Relacionados"),
    (68, 68, "Atividades Imobiliárias"),
    (69, 75, "Atividades Profissionais, Científicas e Técnicas"),
    (77, 82, "Atividades Administrativas e Serviços Complementares"),
    (84, 84, "Administração Pública, Defesa e Seguridade Social"),
    (85, 85, "Educação"),
    (86, 88, "Saúde Humana e Serviços Sociais"),
    (90, 93, "Artes, Cultura, Esporte e Recreação"),
    (94, 96, "Outras Atividades de Serviços"),
    (97, 97, "Serviços Domésticos"),
    (99, 99, "Organismos Internacionais e Outras Instituições Extraterritoriais"),
)

# Names of the generations of the movement files.
NEW_LAYOUT = "Novo CAGED"
OLD_LAYOUT = "CAGED antigo"
NEW_TABLES = ("caged_mov", "caged_for", "caged_exc")
OLD_TABLES = ("caged_old", "caged_ajustes")
CENSUS_TABLES = ("rais_estab", "rais_vinc")

# Activity and occupation columns of each table.
SCOPE_COLUMNS = {
    "caged_mov": ("subclasse", "cbo2002ocupacao"),
    "caged_for": ("subclasse", "cbo2002ocupacao"),
    "caged_exc": ("subclasse", "cbo2002ocupacao"),
    "caged_old": ("cnae_20_subclas", "cbo_2002_ocupacao"),
    "caged_ajustes": ("cnae_20_subclas", "cbo_2002_ocupacao"),
    "rais_vinc": ("cnae_20_subclasse", "cbo_ocupacao_2002"),
    "rais_estab": ("cnae_20_subclasse", None),
}

# Columns that are numbers written as text, and the types they get.
NUMBERS_NEW = {"idade": "smallint", "horascontratuais": "double", "salario": "double", "valorsalariofixo": "double", "saldomovimentacao": "tinyint"}
NUMBERS_OLD = {"idade": "smallint", "qtd_hora_contrat": "double", "salario_mensal": "double", "tempo_emprego": "double", "saldo_mov": "tinyint"}
NUMBERS_CENSUS = {
    "qtd_vinculos_clt": "int", "qtd_vinculos_ativos": "int", "qtd_vinculos_estatutarios": "int",
    "idade": "smallint", "qtd_hora_contr": "smallint", "qtd_dias_afastamento": "smallint",
    "tempo_emprego": "double", "vl_remun_media_nom": "double", "vl_remun_media_sm": "double",
    "vl_remun_dezembro_nom": "double", "vl_remun_dezembro_sm": "double",
}

# Columns that are months written YYYYMM.
MONTHS_NEW = ("competenciamov", "competenciadec")
MONTHS_OLD = ("competencia_movimentacao", "competencia_declarada", "competencia_dec")

# Lineage columns, in their order at the end of a row.
TECHNICAL = ("ano_particao", "mes_particao", "recorte_particao", "arquivo_fonte", "caminho_fonte", "data_ingestao")

# Fields of the layout sheet that list codes, and the column each describes.
LAYOUT_FIELDS = {
    "ADMITIDOS/DESLIGADOS": "admitidosdesligados",
    "FX EMP JAN": "faixa_empr_inicio_jan",
    "GRAU INSTR": "grau_instrucao",
    "IBGE SUBSETOR": "ibge_subsetor",
    "IND APRENDIZ": "ind_aprendiz",
    "PORT DEFIC": "ind_portador_defic",
    "RACACOR": "raca_cor",
    "SEXO": "sexo",
    "TIPO ESTBL": "tipo_estab",
    "TP DEFIC": "tipo_defic",
    "TP MOV DESAG": "tipo_mov_desagregado",
    "UF": "uf",
    "IND TRAB PARCIAL": "ind_trab_parcial",
    "IND TRAB INTERMITENTE": "ind_trab_intermitente",
}

# Columns of the sheet "outros", and the column each describes.
SIDE_BY_SIDE = {
    "col_00": "mesorregiao", "col_01": "microrregiao", "col_02": "regiao_adm_rj", "col_03": "regiao_adm_sp",
    "col_04": "regiao_gov_sp", "col_05": "regiao_senai_sp", "col_06": "regiao_senac_pr", "col_07": "regiao_senai_pr",
    "col_08": "subregiao_senai_pr", "col_09": "regiao_corede_04", "col_10": "regiao_corede",
}

# Sheets of the old layout that list "code:description" for a column.
OLD_SHEETS = {
    "municipio": "municipio", "cbo_2002_ocupacao": "cbo2002", "cbo_94_ocupacao": "cbo_94", "cnae_10_classe": "classe_10",
    "cnae_20_classe": "classe_20", "cnae_20_subclas": "subclasse", "bairros_sp": "bairro_sp", "bairros_fortaleza": "bairro_fort",
    "bairros_rj": "bairro_rj", "distritos_sp": "distrito_sp", "regioes_adm_df": "reg_adm_df",
}

# Workbooks of the census tables, and their layout sheets.
CENSUS_WORKBOOKS = {"rais_vinc": "rais_vinculos_layout2020", "rais_estab": "rais_estabelecimento_layout2018e2019"}
CENSUS_LAYOUT_SHEETS = {"rais_vinc": "raisd_layout", "rais_estab": "estb_layout"}

# Fields of the census layout sheets, and sheets with their columns (code, description) for others.
CENSUS_LINK_FIELDS = {
    "causa_afastamento_1": "CAUS AFAST 1", "causa_afastamento_2": "CAUS AFAST 2", "causa_afastamento_3": "CAUS AFAST 3",
    "motivo_desligamento": "CAUSA DESLI ou Motivo de Desligamento", "vinculo_ativo_3112": "EMP EM 31/12",
    "ind_cei_vinculado": "IND DE CEI VINC", "ind_simples": "IND SIMPLES", "nacionalidade": "NACIONALIDAD",
    "natureza_juridica": "NAT JURIDICA", "ind_portador_defic": "PORT DEFIC", "raca_cor": "RACA_COR", "sexo_trabalhador": "SEXO",
    "tamanho_estabelecimento": "TAMESTAB", "tipo_admissao": "TIPO ADM", "tipo_estab": "TIPO ESTBL", "tipo_estab_1": "TIPO ESTBL",
    "tipo_defic": "TP DEFIC", "tipo_vinculo": "TP VINCULO",
}
CENSUS_LINK_LISTS = {
    "municipio": "municipio", "mun_trab": "municipio", "cbo_ocupacao_2002": "ocupacao",
    "cnae_20_subclasse": "subclasse_2_0", "cnae_95_classe": "classe_1_0_ou_95",
}
CENSUS_LINK_PAIRS = {
    "escolaridade_apos_2005": ("escolaridade_ou_g_instrucao", "col_02", "col_00"),
    "mes_admissao": ("mes_adm_ou_desl", "col_00", "col_01"),
    "mes_desligamento": ("mes_adm_ou_desl", "col_00", "col_01"),
    "regioes_adm_df": ("reg_adm_df", "col_00", "col_01"),
    "distritos_sp": ("distrito_sp", "col_00", "col_01"),
    "bairros_sp": ("bairro_sp", "col_02", "col_01"),
    "bairros_rj": ("bairro_rj", "col_02", "col_01"),
    "bairros_fortaleza": ("bairro_fort", "col_02", "col_01"),
    "faixa_etaria": ("faixas", "col_00", "col_01"),
    "faixa_remun_media_sm": ("faixas", "col_02", "col_03"),
}
CENSUS_ESTAB_FIELDS = {
    "natureza_juridica": "Natureza Jurídica", "tamanho_estabelecimento": "Tamanho Estabelecimento", "tipo_estab": "Tipo Estab",
    "tipo_estab_1": "Tipo Estab", "ind_rais_negativa": "Ind Rais Negativa", "ind_estab_participa_pat": "Ind Estab Participa PAT",
    "ind_simples": "Ind Simples", "ind_cei_vinculado": "Ind CEI Vinculado", "ind_atividade_ano": "Ind Atividade Ano",
}
CENSUS_ESTAB_LISTS = {"municipio": "municipio", "cnae_20_subclasse": "subclasse_2_0", "cnae_95_classe": "classe_1_0_ou_95"}
CENSUS_ESTAB_PAIRS = {
    "regioes_adm_df": ("reg_adm_df", "col_02", "col_01"),
    "distritos_sp": ("distrito_sp", "col_02", "col_01"),
    "bairros_sp": ("bairro_sp", "col_02", "col_01"),
    "bairros_rj": ("bairro_rj", "col_02", "col_01"),
    "bairros_fortaleza": ("bairro_fort", "col_02", "col_01"),
}

# Header words that sheets repeat as data.
HEADERS_TWO = ("Código", "CÓDIGO", "codigo")
HEADERS_TITLE = ("valor na fonte", "codigo", "código", "categorias", "descricao", "descrição")

# The month column by which each table is sorted.
SORT_COLUMN = {
    "caged_mov": "competenciamov_data", "caged_for": "competenciamov_data", "caged_exc": "competenciamov_data",
    "caged_old": "competencia_declarada_data", "caged_ajustes": "competencia_movimentacao_data",
}

# Expected bronze files of each table, and the dataset each belongs to.
EXPECTED_FILES = {"caged_ajustes": 128, "caged_exc": 75, "caged_for": 77, "caged_mov": 78, "caged_old": 156, "rais_estab": 19, "rais_vinc": 349}
DATASET_OF = {
    "caged_mov": "novo_caged", "caged_for": "novo_caged", "caged_exc": "novo_caged", "caged_old": "caged",
    "caged_ajustes": "caged_ajustes", "rais_vinc": "rais", "rais_estab": "rais",
}

# Folders that are not read, and extensions of archives and of data files.
SKIPPED_FOLDERS = ("legado", "eec")
ARCHIVES = ("7z", "zip")
LEAST_DATA_BYTES = 10 * 1024
